import threading

from tessera.scratch import materialize, scratch_scope


def test_scopes_own_what_their_thread_made(spark):
    made, ready, go = {}, threading.Event(), threading.Event()

    def other():
        made["theirs"] = materialize(spark.range(5), "theirs")
        ready.set()
        go.wait(60)

    with scratch_scope(spark) as scope:
        thread = threading.Thread(target=other)
        thread.start()
        ready.wait(60)
        gone = materialize(spark.range(3), "gone")
        kept = scope.keep(materialize(spark.range(4), "kept"))
    go.set()
    thread.join()
    assert made["theirs"].count() == 5 and kept.count() == 4
    assert not _there(spark, gone)


def test_an_outer_scope_deletes_what_an_inner_one_kept(spark):
    with scratch_scope(spark):
        with scratch_scope(spark) as inner:
            kept = inner.keep(materialize(spark.range(4), "kept"))
        assert kept.count() == 4
    assert not _there(spark, kept)


def _there(spark, df) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
