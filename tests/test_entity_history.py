"""The whole history of each entity: its page's lines, as processing the documents one by one writes them."""
import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.operators import pages as PG
from recflow.plans import enrich_plans as EP
import __spark_entry__ as entry
from tools.oracle_check import digest

SCHEMA = "entity string, doc_key string, category string, recorded_date string, line string"


def processed(rows):
    """entity -> its page, document by document: a new line goes right under the heading, one that is there is skipped."""
    pages = defaultdict(list)
    for r in sorted(rows, key=lambda r: (vocab.BUCKETS.index(r["category"]), r["doc_key"], r["line"])):
        if r["line"] not in pages[r["entity"]]:
            pages[r["entity"]].insert(0, r["line"])
    return pages


def mentions(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        key, day = f"d{rng.randrange(n):05d}", f"2026-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}"
        rows.append({"entity": "Hot Part" if k % 3 == 0 else f"Company {rng.randrange(30)}", "doc_key": key,
                     "category": vocab.BUCKETS[int(key[1:]) % 5], "recorded_date": day, "line": f"- {day} — [[{key}]] — title"})
    return rows + rows[::10]  # lines that come again, one document in two rows


def test_lines_stand_as_they_are_processed(spark):
    rows = mentions(2000)
    want = processed(rows)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(7)
    for size in (40, 10_000):
        got = defaultdict(list)
        for r in sorted(PG.entity_history(df, part_lines=size).collect(), key=lambda r: (r["entity"], r["part"])):
            lines, mine = r["lines"].split("\n"), [x for x in rows if x["entity"] == r["entity"]]
            got[r["entity"]] += lines
            assert len(lines) == r["n_lines"] <= size and r["n_mentions"] == len(mine)
            days = [x["recorded_date"] for x in mine]
            assert (r["first_date"], r["last_date"]) == (min(days), max(days))
        assert got == want and len(want["Hot Part"]) > 40 and len(want["Hot Part"]) < sum(r["entity"] == "Hot Part" for r in rows)
    assert PG.entity_history(spark.createDataFrame([], SCHEMA)).collect() == []


def _tables(spark, root):
    """Own rows of the tables that the enrichment's views read."""
    words = "alpha beta gamma delta epsilon".split()
    for name, rows, schema in (
            ("documents", [(i, f"{words[i % 5]} met Vendor {i % 4} and Buyer {i % 7}, about the Blue Bolt.", "en", "a", 40 + i) for i in range(90)],
             "doc_id long, text string, lang string, source string, n_chars long"),
            ("conversations", [(i, t, "user", f"turn {t} with Buyer {i}") for i in range(5) for t in range(2)],
             "conv_id long, turn long, role string, text string"),
            ("supplier", [(i, f"Vendor {i}", 1, 0.0) for i in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
            ("customer", [(i, f"Buyer {i}", 1, 0.0, "m") for i in range(7)],
             "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            ("part", [(i, ("Blue Bolt", "Red Widget")[i % 2], "b", "t", 1, 1.0) for i in range(4)],
             "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")


def test_query_tells_every_line_of_an_entity(spark, tmp_path):
    sf = str(tmp_path)
    _tables(spark, sf)
    found = entry.queries()["entity_history"](spark, sf)
    got = found.collect()
    facts = {r["doc_key"]: r for r in EP.prepared(spark, sf).select("doc_key", "category", "recorded_date", "title_eff").collect()}
    rows = []
    for m in EP._mentions(spark, sf).collect():
        d = facts[m["doc_key"]]
        rows.append({"entity": m["name"], "doc_key": m["doc_key"], "category": d["category"],
                     "line": f"- {d['recorded_date']} — [[{m['doc_key']}]] — {d['title_eff']}"})
    want = processed(rows)
    assert {r["entity"]: r["lines"].split("\n") for r in got} == want
    assert max(map(len, want.values())) > 60 and len({r["category"] for r in rows}) == 5
    con = duckdb.connect()
    for t in ("documents", "conversations", "supplier", "customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    res = con.execute(entry.oracle_sql()["entity_history"])
    assert digest(found.columns, [tuple(r) for r in got])[0] == digest([d[0] for d in res.description], res.fetchall())[0]


def test_history_is_spread_over_tasks(spark):
    """No task gathers more of a page than a part; a page's numbers are those of all its parts."""
    df = spark.range(30_000).select(F.lit("one").alias("entity"), F.lpad(F.col("id").cast("string"), 6, "0").alias("doc_key"),
                                    F.lit("Casual").alias("category"), F.lit("2026-01-01").alias("recorded_date"))
    parts = PG.entity_history(df.withColumn("line", F.concat(F.lit("line "), "doc_key")), part_lines=1000).collect()
    assert sorted(r["part"] for r in parts) == list(range(30)) and {(r["n_lines"], r["n_mentions"]) for r in parts} == {(1000, 30_000)}
    joined = [line for r in sorted(parts, key=lambda r: r["part"]) for line in r["lines"].split("\n")]
    assert joined == [f"line {k:06d}" for k in range(29_999, -1, -1)]
