from tessera.plans import validation as V
from tessera.plans.adapters import Source
from tests.test_oracle import SF


def test_corpus_is_whole(spark):
    s = Source(spark, SF)
    got = {r["entity"]: r["count"] for r in V.corpus(s).groupBy("entity").count().collect()}
    assert got == {"work": s.t("documents").count(), "person": s.t("customer").count(), "event": s.t("orders").count()}
    assert V.QUERIES["title_forms"](spark, SF).count() == s.t("customer").count()


def scans(df):
    """Leaves of the optimized plan that read files."""
    return sum(leaf.nodeName().startswith("LogicalRelation") or "Relation" in leaf.nodeName() for leaf in leaves(df._jdf.queryExecution().optimizedPlan().collectLeaves()))


def leaves(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_audit_reads_the_corpus_few_times(spark):
    s = Source(spark, SF)
    assert 0 < scans(V.QUERIES["audit_counts"](spark, SF)) <= 24
    once = scans(V.corpus(s))
    alone = V.R.metadata_rules(V.corpus(s), V.CONFIG, V.AS_OF)
    assert scans(alone) == once
