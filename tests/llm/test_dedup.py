"""Exact, near and line dedup against brute force, and their odd cases."""

import itertools
import random
import re
import time

import pytest

from leafmark.llm import exact_dedup, line_dedup, near_dedup, scratch

SF = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], KIND)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)])) for i, t in rows)


ODD = [(1, "a  b"), (2, "a b"), (3, "a\t\nb"), (4, None), (5, ""), (6, " "), (7, "\n"), (8, "A b"), (9, "a b "), (10, "é" * 5), (11, "x " * 30_000), (12, "x  " * 30_000)]


@pytest.mark.parametrize("bits", [256, 8])
def test_exact_matches_brute_force(spark, bits):
    rows = [*ODD, *((r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())]
    got = exact_dedup.exact_duplicates(table(spark, rows), bits=bits).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute_exact(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_state_outlives_a_call(spark):
    stream = exact_dedup.StreamingExactDedup(spark)
    first, second = [(5, "one"), (6, "two")], [(3, "one"), (7, "two"), (8, "three")]
    stream.ingest(table(spark, first))
    stream.ingest(table(spark, second))
    got = stream.decided(table(spark, first + second)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == brute_exact(first + second)


def test_exact_odd_rows(spark):
    assert exact_dedup.exact_duplicates(table(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "a", 1, "x"), (2, "a", 1, "y"), (2, "a", 1, "z"), (None, None, 1, "w")], "doc_id long, text string, digest int, keep string")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(rows).collect()}
    assert got == {(None, 2, 3, False), (2, 2, 3, True), (None, None, 1, True)}
    kept = exact_dedup.without_duplicates(rows)
    assert kept.columns == rows.columns and sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, None), (2, "a")]


@pytest.mark.parametrize("bits", [256, 8])
def test_dropping_goes_by_row(spark, tmp_path, bits):
    rows = [(1, "a"), (2, "a"), (2, "unique b"), (None, "c c"), (None, "c  c"), (3, "d"), (3, "d"), (None, None), (None, ""), *((100 + k, f"text {k // 2}") for k in range(400))]
    frame = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _metadata string, place int")
    frame.drop("_metadata").repartition(5).write.parquet(str(tmp_path / "docs"))
    want = sorted({(min((j if j is not None else 2**63 for j, u in rows if norm(u) == norm(t))), norm(t)) for _, t in rows})
    for docs in (frame, spark.read.parquet(str(tmp_path / "docs"))):
        got = exact_dedup.without_duplicates(docs, bits=bits)
        assert got.columns == docs.columns
        assert sorted((r.doc_id if r.doc_id is not None else 2**63, norm(r.text)) for r in got.collect()) == want


def test_near_dropping_goes_by_row(spark):
    base = [f"w{k}" for k in range(60)]
    changed = [*base[:59], "other"]
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (2, "something else that is unlike all other texts of this table"), (None, " ".join(base)), (None, "no id and alone in the table here"), (None, "no id and alone in the table  here"), (5, None), (6, "")]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, root int")
    kept = near_dedup.without_near_duplicates(frame, percent=80).collect()
    assert sorted(r.root for r in kept if r.root not in (4, 5)) == [0, 2, 6, 7] and len(kept) == 5
    by_row = near_dedup.near_duplicates(frame, percent=80).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in by_row if r.component_id) == [(-1, 1), (1, 1), (2, 1), (2, 2), (5, 5), (6, 6)]


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def components(sets, linked):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and linked(sets[a], sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in sets}


def near(percent):
    return lambda a, b: 100 * len(a & b) >= percent * len(a | b)


def varied(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_near_matches_brute_force(spark, percent):
    rows = [(i, t) for i, t in enumerate([*(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), *varied(1, 60), *varied(2, 40), "", None, " ", "one", "One", "one two", "a b c d e f g h", "a b c d e f g H"])]
    want = components({i: shingles(t) for i, t in rows}, near(percent))
    got = near_dedup.near_duplicates(table(spark, rows), percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_odd_rows(spark):
    assert near_dedup.near_duplicates(table(spark, [])).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f", 1), (2, "a b c d e f", 2), (2, "a b c d e f", 3), (None, None, 4), (9, "z", 5)], "doc_id long, text string, keys int")
    got = sorted(((r.doc_id or -1, r.component_id, r.kept) for r in near_dedup.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(-1, 2, False), (2, 2, True), (2, 2, True), (-1, None, True), (9, 9, True)], key=str)
    long = " ".join(f"w{k % 977}" for k in range(200_000))
    rows = spark.createDataFrame([(1, long), (2, long + " more"), (3, long.upper())], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(rows).collect()} == {1}
    assert near_dedup.without_near_duplicates(rows).columns == rows.columns


def test_lines_match_brute_force(spark):
    rng = random.Random(4)
    docs = [(r.doc_id, r.text[:1500]) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    long = "the quick brown fox jumps over the lazy dog and runs far away into the dark green wood"
    docs += [(1000 + k, "\n".join([long.replace("dark", rng.choice(["dark", "bark", "park"])), "  " + long.upper(), "short", "Short ", "", " ", "tiny"])) for k in range(4)] + [(2000, None), (2001, ""), (2002, "\n\n")]
    lines = {}
    for i, t in docs:
        for n, x in enumerate((t or "").split("\n")):
            x = re.sub("[A-Z]", lambda m: m[0].lower(), x).strip(" \t\x0b\x0c\r\n")
            if x:
                lines[i, n] = x.encode()
    own = {x: frozenset(line_dedup.shingles(x).tolist()) for x in lines.values()}
    names = {x: k for k, x in enumerate(sorted(own))}
    root = components({names[x]: s for x, s in own.items()}, near(80))
    best, size = {}, {}
    for at, x in lines.items():
        r = root[names[x]]
        best[r], size[r] = min(best.get(r, at), at), size.get(r, 0) + 1
    got = line_dedup.fuzzy_lines(table(spark, docs)).collect()
    assert {(r.doc_id, r.line_no): (r.keep_doc, r.keep_line, r.n_lines) for r in got} == {at: (*best[root[names[x]]], size[root[names[x]]]) for at, x in lines.items()}
    assert sum(r.kept for r in got) == len(best)
    assert line_dedup.fuzzy_lines(table(spark, [])).collect() == []


def test_stars_connect_buckets_across_batches():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 40, 300))
    ids = rng.permutation(300).astype(np.int64)
    for size in (1, 2, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size]), pa.array(ids[i : i + size])], ["key", "id"]) for i in range(0, 300, size)]
        pairs = [(a, b) for out in line_dedup._stars(iter(batches)) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
        key = dict(zip(ids.tolist(), keys.tolist(), strict=True))
        assert all(key[a] == key[b] for a, b in pairs) and len(pairs) <= 2 * 300 + len(batches)
        root = {i: i for i in key}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        assert len({find(i) for i in key}) == len(set(keys.tolist()))


def test_lines_of_one_template_match_brute_force(spark):
    import numpy as np

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4000)]
    base = [rng.choice(words) for _ in range(60)]

    def changed():
        line = list(base)
        for at in rng.sample(range(len(line)), rng.choice([3, 4])):
            line[at] = rng.choice(words)
        return " ".join(line)

    # lines of one template, mostly 0.6 to 0.78 alike; what two linked ones share is the template's, so many others share it
    lines = list(dict.fromkeys(changed() for _ in range(1500)))
    sets = [line_dedup.shingles(x.encode()) for x in lines]
    column = {s: k for k, s in enumerate(sorted({s for x in sets for s in x.tolist()}))}
    has = np.zeros((len(lines), len(column)), np.float32)
    for i, x in enumerate(sets):
        has[i, [column[s] for s in x.tolist()]] = 1
    common, n = has @ has.T, has.sum(1)
    links = np.argwhere(np.triu(100 * common >= 80 * (n[:, None] + n[None, :] - common), 1))
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links.tolist():
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = [find(i) for i in range(len(lines))]
    assert len(links) > 500 and 300 < len(set(want)) < 1300
    got = line_dedup.fuzzy_lines(table(spark, list(enumerate(lines)))).collect()
    assert [r.keep_doc for r in sorted(got, key=lambda r: r.doc_id)] == want


@pytest.mark.parametrize("held", [3, 50, 1 << 22])
def test_cells_keep_buckets_connected(monkeypatch, held):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    lines = [bytes(rng.choice([97, 98, 99], 12)).decode() for _ in range(30)]
    lines = [x + y for x in lines for y in ("", "a", "b é")] + [f"{lines[0]}{k}" for k in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, min(i + 20, len(lines))), pa.int64()), pa.array([x.encode() for x in lines[i : i + 20]], pa.binary())], ["id", "line"]) for i in range(0, len(lines), 20)]
    members = {}
    for b in line_dedup._keys(iter(batches)):
        for key, at in zip(b["key"].to_pylist(), b["id"].to_pylist(), strict=True):
            members.setdefault(key, set()).add(at)
    monkeypatch.setattr(line_dedup, "HELD", held)
    monkeypatch.setattr(line_dedup, "DEAL", 500)
    for cells in (1, 7, 100_000):
        packed = list(line_dedup._dealt(cells)(iter(batches)))
        assert sum(len(x.as_buffer()) for b in packed for x in b["pairs"]) == 16 * 16 * len(lines)
        # pairs are not rows: a cell has one row each time that a task deals
        assert all(len(set(b["cell"].to_pylist())) == b.num_rows <= cells for b in packed)
        rows = pa.Table.from_batches(packed).sort_by("cell").combine_chunks().to_batches(max_chunksize=4)
        links, total = {}, 0
        for out in line_dedup._cell_stars(iter(rows)):
            for a, b, key in zip(out["a"].to_pylist(), out["b"].to_pylist(), out["key"].to_pylist(), strict=True):
                assert a < b and {a, b} <= members[key]
                links.setdefault(key, []).append((a, b))
                total += 1
        for key, ids in members.items():
            left, seen = [min(ids)], {min(ids)}
            while left:
                x = left.pop()
                for a, b in links.get(key, []):
                    if x in (a, b) and (y := a + b - x) not in seen:
                        seen.add(y)
                        left.append(y)
            assert seen == ids
        assert held < 100 or total <= 2 * 16 * len(lines)


def test_lines_keep_no_shuffle_files_of_finished_steps(spark, monkeypatch):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    written, left = scratch.written, set()

    def shuffles():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return set(re.findall(r"shuffle_\d+", names))

    def watched(*args):
        out, end = written(*args), time.monotonic() + 5
        # files are deleted shortly after a query; without that they wait for the driver's garbage collection
        while not left and shuffles() - before:
            if time.monotonic() > end:
                left.update(shuffles() - before)
            time.sleep(0.02)
        return out

    long = "the quick brown fox jumps over the lazy dog and runs far away into the dark green wood"
    docs = table(spark, [(k, f"{long}\n{long} {k}\nother line {k % 7}") for k in range(40)]).repartition(3).cache()
    assert docs.count() == 40
    before, was = shuffles(), spark.conf.get(name, None)
    monkeypatch.setattr(scratch, "written", watched)
    lines = line_dedup.fuzzy_lines(docs)
    assert not left
    # the result is built lazily: it and the input may be read again
    assert spark.conf.get(name, None) == was
    first = sorted(lines.collect())
    assert sorted(lines.collect()) == first and len(first) == 120
    assert docs.count() == docs.unpersist().count() == 40
