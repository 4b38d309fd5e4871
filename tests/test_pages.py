"""Sorted pages against Python's sort, with one entity in a third of all lines."""
import os
import random
from collections import defaultdict

from pyspark.sql import functions as F

from recflow.operators import pages as PG

SCHEMA = "entity string, recorded_date string, line string, doc_key string"


def lines(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        entity = "Hot Person" if k % 3 == 0 else rng.choice([f"Company {j}" for j in range(40)] + ["a/b", "100%", ".hidden", None])
        day = f"2026-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}"
        rows.append((entity, day, rng.choice([f"- {day} — [[d{k}]] — title", f"- {day} — same", None]), f"d{k:06d}"))
    return rows


def want(rows, size):
    pages = defaultdict(list)
    for entity, day, line, _ in rows:
        pages[entity or ""].append((day, line or ""))
    out = {}
    for page, found in pages.items():
        found = [line for _, line in sorted(found, reverse=True)]
        for part in range(0, len(found), size):
            head = "## Recent Mentions\n\n" if part == 0 else ""
            out[page, part // size] = head + "\n".join(found[part:part + size]) + "\n"
    return out


def test_entity_pages_equal_sorting(spark):
    rows = lines(4000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for size in (100, 10_000):
        got = {(r.page, r.part): r.text for r in PG.entity_pages(df, part_lines=size).collect()}
        assert got == want(rows, size)
    assert len([k for k in want(rows, 100) if k[0] == "Hot Person"]) == 14
    assert PG.entity_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_page_is_spread_over_tasks(spark):
    """The lines of one page fill several range partitions; no task gathers more than a part."""
    df = spark.range(30_000).select(F.lit("one").alias("entity"), F.lit("2026-01-01").alias("recorded_date"),
                                    F.concat(F.lit("line "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("line"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        picked = df.select(F.col("entity").alias("page"), "line")
        placed = PG._placed(picked, [F.col("page"), F.col("line")])
        assert [r.place for r in placed.orderBy("line").collect()] == list(range(30_000))
        tasks = picked.repartitionByRange("page", "line").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 15_000
        parts = PG.entity_pages(df, part_lines=1000).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(r.part for r in parts) == list(range(30)) and {r.n_lines for r in parts} == {1000}
    joined = "".join(r.text for r in sorted(parts, key=lambda r: r.part)).split("\n")
    assert joined[2:-1] == [f"line {k:06d}" for k in range(29_999, -1, -1)]


def test_pages_written_as_files(spark, tmp_path):
    rows = lines(600)
    df = spark.createDataFrame(rows, SCHEMA)
    written = PG.write_pages(PG.entity_pages(df, part_lines=50), str(tmp_path.as_uri()), "People").collect()
    texts = want(rows, 50)
    assert len(written) == len(texts) == len(os.listdir(tmp_path / "People"))
    assert (tmp_path / "People" / "Hot Person.md").read_text() == texts["Hot Person", 0]
    assert (tmp_path / "People" / "Hot Person (2).md").read_text() == texts["Hot Person", 1]
    assert (tmp_path / "People" / "a%2Fb.md").read_text() == texts["a/b", 0]


def test_only_changed_pages_are_written_again(spark):
    rows = lines(300)
    df = spark.createDataFrame(rows, SCHEMA).where("entity IS NOT NULL")
    new = df.where("doc_key = 'd000000'")
    again = PG.entity_pages(PG.changed_pages(df, new, "entity")).collect()
    assert [(r.page, r.text) for r in again] == [("Hot Person", want(rows, 10_000)["Hot Person", 0])]


def test_day_pages(spark):
    blocks = [("2026-02-01", "b", "## From [[b]]\n\n- [ ] second\n"), ("2026-02-01", "a", "## From [[a]]\n\n- [ ] first\n"), ("2026-02-02", "c", "## From [[c]]\n")]
    got = {r.page: r.text for r in PG.day_pages(spark.createDataFrame(blocks, "recorded_date string, doc_key string, block string")).collect()}
    assert got["2026-02-01"] == ("---\ndate: 2026-02-01\ntype: action-items-rollup\ntags: [action-items, transcript-derived]\n---\n\n"
                                 "# Action Items — 2026-02-01\n\n## From [[a]]\n\n- [ ] first\n\n## From [[b]]\n\n- [ ] second\n\n")
    assert set(got) == {"2026-02-01", "2026-02-02"}
