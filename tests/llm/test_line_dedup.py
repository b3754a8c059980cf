"""Line de-duplication against a plain loop, the order of batches, compaction, and the SQL form."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tradescope.llm import line_dedup
from tradescope.llm.line_dedup import LineRuns, batch_of, dedup_lines, line_digest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=20, docs=3):
    """(doc_id, kept text, lines, dropped) per row; a null id ranks below all."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least:
                holders[k].append(doc_id)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


LINE = "This line is long enough to count"
ODD = "ÄÖÜ äöü ß 漢字漢字 éééé İıſ Kelvin"
ROWS = [
    (1, f"{LINE}\nown 1\n  {LINE.upper()}\t"),
    (2, f"\x0b{LINE}\x0c\nown 2"),
    (9, f"own 9\n{LINE}\n{LINE}"),
    (9, f"{LINE}\nsecond row of nine"),
    (3, f"{ODD}\n\n"),
    (4, f"{ODD}\n {ODD}"),
    (5, f"{ODD}\r\nx"),
    (6, "éééééééééééééééééééé"),
    (7, "éééééééééééééééééééé\nééééééééééééééééééé"),
    (8, "éééééééééééééééééééé\nééééééééééééééééééé"),
    (10, "ééééééééééééééééééé"),
    (11, None),
    (12, ""),
    (13, "\n\n"),
    (None, f"{LINE}\nnameless"),
    (None, "only rows without an id hold this"),
    (None, "only rows without an id hold this"),
    (None, "only rows without an id hold this"),
    (14, "held by two documents only, so it stays"),
    (15, "held by two documents only, so it stays"),
    *[(16, f"{ODD}\nthe same row again and again")] * 5,
    (17, "\n".join(f"a long text, line number {k}" for k in range(3000))),
    (18, "\n".join(f"a long text, line number {k}" for k in range(0, 3000, 2))),
    (19, "\n".join(f"A LONG TEXT, line number {k} " for k in range(0, 3000, 3))),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def texts(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_against_a_plain_loop(spark):
    assert texts(dedup_lines(frame(spark, ROWS))) == sorted(plain(ROWS), key=str)


def test_hot_keys_by_broadcast_or_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 1_000_000)  # every repeated key counts as hot
    every = texts(dedup_lines(frame(spark, ROWS), batches=2))
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 0.5)  # none does
    assert texts(dedup_lines(frame(spark, ROWS), batches=2)) == every == sorted(plain(ROWS), key=str)


def test_clashing_columns_other_limits_and_one_batch(spark):
    df = frame(spark, ROWS).withColumn("t1", F.lit("x")).withColumn("hashes", F.lit(1)).withColumn("batch", F.lit(2)).withColumn("n_lines", F.lit(0))
    assert texts(dedup_lines(df, 5, 2, batches=1)) == sorted(plain(ROWS, 5, 2), key=str)


def test_empty_table(spark):
    assert dedup_lines(frame(spark, [])).collect() == []


def keys(spark, rows):
    return spark.createDataFrame([(h.encode(), n, top) for h, n, top in rows], "h binary, n long, top long")


def test_runs_in_any_order_of_batches(spark):
    batches = [[("a", 1, 9), ("b", 1, 8)], [("a", 2, 4)], [("a", 5, 3), ("b", 1, None)], [("b", 1, 7), ("c", 3, None)], [("a", 1, 12), ("c", 1, 1)]]
    for order in (batches, batches[::-1]):
        index = LineRuns(spark, 3, fanout=2)
        for rows in order:
            index.add(keys(spark, rows))
        assert len(index.runs()) == 2 and [len(x) for x in index.levels] == [1, 0, 1]  # 5 = 101 in runs of two
        got = {bytes(r.h).decode(): (r.n >= 3, r.top) for r in index.merged().collect()}
        assert got == {"a": (True, 12), "b": (True, 8), "c": (True, 1)}
        index.drop()
        assert index.runs() == []


def test_settled_keys_are_not_written_again(spark):
    index = LineRuns(spark, 3, fanout=4)
    index.add(keys(spark, [("a", 3, 100), ("b", 2, 99)]))
    index.add(keys(spark, [("a", 50, 80), ("b", 50, 79)]))
    index.add(keys(spark, [("a", 50, 70), ("b", 50, 69), ("c", 1, 60)]))
    rows = [sorted(bytes(r.h).decode() for r in spark.table(name).collect()) for name in index.runs()]
    assert rows == [["a", "b"], ["b"], ["c"]]
    index.drop()


def test_run_side_of_the_join_is_not_shuffled(spark):
    index = LineRuns(spark, 3)
    index.add(keys(spark, [("a", 3, 100)]))
    plan = index.unsettled(keys(spark, [("b", 3, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    index.drop()


def test_batches_run_from_the_largest_ids(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    df = df.unionByName(spark.createDataFrame([(None,)], "doc_id long"))
    rows = df.select("doc_id", batch_of(df, 4).alias("b")).collect()
    of = {r.doc_id: r.b for r in rows}
    assert of[None] == 3 and of[99] == 0 and of[0] == 3
    assert all(of[k] >= of[k + 1] for k in range(99)) and set(of.values()) == {0, 1, 2, 3}


def test_whole_table_against_plain_loop_and_sql(spark, matches_oracle):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[3] for r in expected) > 0
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_digest(docs).collect()}
    assert got == {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, k in expected}
    assert matches_oracle("op11_line_dedup", "/root/testdata/sf0.001") == docs.count()
