import hashlib
import json
import os
import random

import pytest

from tessera.functions import canonical as C
from tessera.operators import folders
from tessera.sources import scan


def write(root, rel, data):
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_incremental_scan_reads_what_changed(spark, tmp_path):
    root, held = str(tmp_path / "tree"), str(tmp_path / "index")
    for rel in ("a.txt", "b c/é.MD", "b c/d/e.txt", "10_MD_PROCESSED_FILES/x.md", "b c/copy.txt"):
        write(root, rel, b"same" if "copy" in rel or rel == "a.txt" else rel.encode())
    os.symlink(f"{root}/a.txt", f"{root}/link.txt")
    os.symlink(f"{root}/b c", f"{root}/linked")
    none = spark.createDataFrame([], "rel string, size_bytes long, modified_at timestamp, sha256 string, mime_type string")
    scan.incremental_scan(spark, root, none).write.parquet(held)
    first = {r["rel"]: r for r in spark.read.parquet(held).collect()}
    assert set(first) == {"a.txt", "b c/é.MD", "b c/d/e.txt", "b c/copy.txt"} and all(r["hashed"] and r["error"] is None for r in first.values())
    assert first["a.txt"]["sha256"] == hashlib.sha256(b"same").hexdigest() and first["a.txt"]["mime_type"] == "text/plain"
    # what keeps its length and time isn't opened: its bytes change unseen
    quiet = f"{root}/b c/é.MD"
    times = os.stat(quiet)
    write(root, "b c/é.MD", b"B c/\xc3\xa9.MD")
    os.utime(quiet, ns=(times.st_atime_ns, times.st_mtime_ns))
    write(root, "b c/d/e.txt", b"longer than before")
    write(root, "new.txt", b"new")
    os.remove(f"{root}/b c/copy.txt")
    again = {r["rel"]: r for r in scan.incremental_scan(spark, root, spark.read.parquet(held)).collect()}
    assert {k for k, r in again.items() if r["hashed"]} == {"b c/d/e.txt", "new.txt"}
    assert set(again) == {"a.txt", "b c/é.MD", "b c/d/e.txt", "new.txt"}
    assert again["b c/é.MD"]["sha256"] == first["b c/é.MD"]["sha256"] and again["b c/é.MD"]["mime_type"] == first["b c/é.MD"]["mime_type"]
    assert again["b c/d/e.txt"]["sha256"] == hashlib.sha256(b"longer than before").hexdigest()


def test_content_index(spark):
    rows = [("x/b.TXT", 4, "h1", None), ("a.txt", 4, "h1", None), (".bashrc", 1, "h2", None), ("gone", 1, None, "no")]
    files = spark.createDataFrame([(r, n, None, h, "t", e) for r, n, h, e in rows], "rel string, size_bytes long, modified_at timestamp, sha256 string, mime_type string, error string")
    got = {r["sha256"]: (r["paths"], r["filename"], r["extension"], r["file_id"]) for r in scan.content_index(files).collect()}
    assert got == {"h1": (["a.txt", "x/b.TXT"], "b.TXT", ".txt", "sha256:h1"), "h2": ([".bashrc"], ".bashrc", "", "sha256:h2")}


def test_strict_scan_refuses_a_moving_tree(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "tree"), str(tmp_path / "out")
    for i in range(5):
        write(root, f"f{i}", str(i).encode())
    assert {r["rel"] for r in scan.strict_scan(spark, root, target).collect()} == {f"f{i}" for i in range(5)}
    plain, calls = scan.list_files, []

    def meanwhile(*args):
        if calls:
            write(root, "f1", b"longer")
            write(root, "f9", b"new")
        calls.append(1)
        return plain(*args)

    monkeypatch.setattr(scan, "list_files", meanwhile)
    with pytest.raises(ValueError, match="f1: changed; f9: appeared"):
        scan.strict_scan(spark, root, target)


def any_json(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 3:
        return rng.choice([0, -1, 1.0, 0.1, -2.5e-7, 1e22, 123456789.25, 1e16, 9999999999999998.0, 1e-4, 0.0001234, -0.0, 12345678901234567890123, 3.0e5, 2**53 + 1])
    if kind == 3:
        return rng.choice([True, False, None])
    if kind < 6:
        return "".join(rng.choice('ab"\\/\n\t\x01\x1f\x0bé日😀 {}[]:,1.5e') for _ in range(rng.randrange(12)))
    if kind == 6:
        return [any_json(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "B", "é", "k" * rng.randrange(1, 4), "z z", '"q', "1"]): any_json(rng, depth + 1) for _ in range(rng.randrange(5))}


def shuffled(rng, v):
    if isinstance(v, dict):
        items = list(v.items())
        rng.shuffle(items)
        return {k: shuffled(rng, x) for k, x in items}
    return [shuffled(rng, x) for x in v] if isinstance(v, list) else v


def plain(v, escape=False):
    return json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=escape)


def test_canonical_json_is_pythons(spark):
    rng = random.Random(3)
    values = [any_json(rng) for _ in range(600)]
    rows = [(i, json.dumps(shuffled(rng, v), ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2]))) for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (900, "{bad"), (901, None), (902, '{"a":1,"a":2}'), (903, '{"n": 1.50, "m": 1E3}'), (904, '{"a":1}}'), (905, "1,2"), (906, '{"a":1} {"a":1}'), (907, "null")], "id long, j string")
    got = {r["id"]: r for r in df.select("id", C.canonical(df["j"]).alias("c"), C.ascii_escaped(C.canonical(df["j"])).alias("e")).collect()}
    for i, v in enumerate(values):
        assert got[i]["c"] == plain(v), rows[i]
        assert got[i]["e"] == plain(v, True)
    assert got[900]["c"] is None and got[901]["c"] is None and got[902]["c"] is None and got[904]["c"] is None and got[905]["c"] is None and got[906]["c"] is None and got[907]["c"] == "null" and got[903]["c"] == '{"m":1000.0,"n":1.5}'


def test_canonical_without_a_key(spark):
    rows = [(1, {"record_hash": "x", "b": {"record_hash": 1, "a": 2.0}, "a": [1, "é"]}), (2, {"record_hash": "x"}), (3, {'q"': None, "p": True})]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in rows], "id long, j string")
    got = {r["id"]: r["c"] for r in df.select("id", C.canonical_without(df["j"], "record_hash").alias("c")).collect()}
    assert got == {i: plain({k: x for k, x in v.items() if k != "record_hash"}) for i, v in rows}


def drawn(paths, special, shown=12):
    """The tree by recursion."""
    out = []

    def walk(folder, prefix):
        below = folder + "/" if folder else ""
        inside = [p[len(below) :] for p in [*paths, *[s for s, _ in special]] if p.startswith(below)]
        dirs = sorted({x.split("/")[0] for x in inside if "/" in x}, key=lambda x: (x.lower(), x))
        files = sorted((p[len(below) :] for p in paths if p.startswith(below) and "/" not in p[len(below) :]), key=lambda x: (x.lower(), x))
        odd = sorted(((s[len(below) :], label) for s, label in special if s.startswith(below) and "/" not in s[len(below) :]), key=lambda x: (x[0].lower(), x[0]))
        rows = [(d + "/", below + d) for d in dirs] + [(f, None) for f in files[:shown]] + [(label, None) for _, label in odd]
        rows += [(f"… {len(files) - shown} altri file", None)] if len(files) > shown else []
        for i, (label, sub) in enumerate(rows):
            last = i == len(rows) - 1
            out.append(prefix + ("└── " if last else "├── ") + label)
            if sub is not None:
                walk(sub, prefix + ("    " if last else "│   "))

    walk("", "")
    return out


def test_folder_tree(spark):
    rng = random.Random(8)
    paths = sorted({"/".join(rng.choice(["a", "B", "c c", "Dé"]) for _ in range(rng.randrange(4))) + f"/f{rng.randrange(60)}.{rng.choice(['txt', 'MD'])}" for _ in range(300)})
    paths = [p.lstrip("/") for p in paths]
    special = [("a/link", "link@ -> x [SKIPPED]"), ("zz/only", "only [SPECIAL FILE SKIPPED]")]
    files = spark.createDataFrame([(p, len(p)) for p in paths], "path string, size_bytes long")
    odd = spark.createDataFrame(special, "path string, label string")
    assert [r["line"] for r in folders.tree_lines(files, odd).orderBy("ord").collect()] == drawn(paths, special)
    got = {r["folder"]: tuple(r)[1:] for r in folders.folder_sums(files, odd).collect()}
    for folder, (n, size, all_n, all_size, problems) in got.items():
        below = folder + "/" if folder else ""
        inside = [p for p in paths if p.startswith(below)]
        own = [p for p in inside if "/" not in p[len(below) :]]
        assert (n, size, all_n, all_size) == (len(own), sum(map(len, own)), len(inside), sum(map(len, inside)))
        assert problems == sum(s.startswith(below) for s, _ in special)
    assert folders.tree_lines(files.limit(0)).count() == 0 and folders.folder_sums(files.limit(0)).count() == 0


def test_folder_report(spark):
    files = spark.createDataFrame([("a/x.txt", 1, "h1"), ("a/y.txt", 2048, "h1"), ("README", 5, "h2")], "path string, size_bytes long, sha256 string")
    problems = spark.createDataFrame([("a/l", "symlink file skipped")], "path string, problem string")
    text = "\n".join(r["line"] for r in folders.folder_report("Root", files, problems).orderBy("part", "ord").collect())
    assert text.startswith("# Root\n\n**Files successfully inventoried:** 3  \n**Total size:** 2.0 KB\n\n## Directory structure\n\nRoot/\n├── a/\n│   ├── x.txt\n│   ├── y.txt\n│   └── l [symlink file skipped]\n└── README\n\n## File types\n\n- `.txt`: 2\n- `[no extension]`: 1\n")
    assert "- `h1…`\n  - `a/x.txt`\n  - `a/y.txt`" in text and "- `a/`: 2 files, 2.0 KB, 1 problems" in text and text.endswith("- `a/l: symlink file skipped`")
