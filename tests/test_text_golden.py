"""Golden units for projections, header parsing, sections, action items,
entity boundaries, delivery signals, replies and status (expected values
written by hand from the behaviour being reproduced)."""
import pytest
from pyspark.sql import functions as F

from recflow.functions import projections as P
from recflow.functions import vocab
from recflow.operators import actions as A
from recflow.operators import entities as EN
from recflow.operators import reclassify as R
from recflow.operators.delivery import delivery_signal
from recflow.operators.enrich import enrich_pending
from recflow.sources import documents as D
from recflow.sources import listing as L


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).collect()[0]["y"]


@pytest.mark.parametrize("name,slug", [
    ("Hello, World!", "hello-world"),
    ("  --Leading punct", "leading-punct"),
    ("Ünïcode Çafé", "n-code-af"),
    ("a" * 59 + " b", "a" * 59 + "-"),
    ("", ""),
])
def test_slug(spark, name, slug):
    assert one(spark, P.slug("x"), name) == slug


def test_doc_key_and_date_prefix(spark):
    df = spark.createDataFrame([("", "2024-03-04T10:00:00Z", "Team Sync!", "0123456789abcdef0123456789abcdef")],
                               "s string, c string, n string, i string")
    r = df.select(P.doc_key("s", "c", "n", "i").alias("k"), P.date_prefix("s", "c").alias("d")).collect()[0]
    assert r["k"] == "2024-03-04--team-sync--01234567" and r["d"] == "2024-03-04"


def test_title_quote_roundtrip(spark):
    line = F.concat(F.lit("title: "), P.title_escape("x"))
    back = P.title_unquote(F.regexp_replace(line, r"\A[^:]*:", ""))
    assert one(spark, back, 'Say "hi"') == 'Say \\"hi\\'


def test_recorded_date_fallbacks(spark):
    df = spark.createDataFrame([("2024-01-02T09:00", ""), ("", "2024-02-03T10:00"), ("", ""), (None, None)],
                               "r string, u string")
    got = [r["d"] for r in df.select(P.recorded_date("r", "u", "2030-01-01").alias("d")).collect()]
    assert got == ["2024-01-02", "2024-02-03", "2030-01-01", "2030-01-01"]


HDR = '---\ntitle: "First"\ntitle: Second\n  indented: skipped\nno colon\nlink: "a:b"\n---\nbody\n'


def test_frontmatter_map_last_wins_title_first(spark):
    df = spark.createDataFrame([(HDR, "stem")], "text string, stem string")
    r = df.select(D.frontmatter_map("text").alias("m"), D.frontmatter_title("text", "stem").alias("t")).collect()[0]
    assert r["m"] == {"title": "Second", "link": "a:b"}
    assert r["t"] == "First"


@pytest.mark.parametrize("text,title,has", [
    ("---\ntitle: A\n", "stem", False),          # no closing line: no header
    ("# just text", "stem", False),
    ("---\n---\nbody", "stem", False),            # needs an empty line between the rules
    ("---\n\n---\nbody", "stem", True),           # empty header
    ("---\ntitle:\n---\n", "", True),             # an empty title stays empty
])
def test_header_edges(spark, text, title, has):
    df = spark.createDataFrame([(text, "stem")], "text string, stem string")
    r = df.select(D.frontmatter_title("text", "stem").alias("t"), D.has_header("text").alias("h")).collect()[0]
    assert (r["t"], r["h"]) == (title, has)


SECTION_DOC = ("intro\n## AI Summary\n\nfirst body\n### sub stays\n## Next\nnext body\n"
               "##  ai summary  \nsecond\n## Last\n  tail  \n")


@pytest.mark.parametrize("heading,body", [
    ("AI Summary", "first body\n### sub stays"),
    ("next", "next body"),
    ("Last", "tail"),
    ("Missing", ""),
])
def test_section_extract(spark, heading, body):
    assert one(spark, D.section_extract("x", heading), SECTION_DOC) == body


ITEMS = [
    # heading form, checkbox strip, noise filters (placeholder, label, @assignee, too short)
    ("## Next Steps\n- [ ] Send the deck to Ana\n- insert more here\n- Owners:\n- @Dana Smith\n"
     "- 7 chars\n- 8 chars!\n* Star bullet item\n> - Quoted bullet item\n\n## Notes\n- after section\n",
     ["Send the deck to Ana", "8 chars!", "Star bullet item", "Quoted bullet item"]),
    # bullet-label fallback; a rule line ends the chunk
    ("Intro\n- Action Items:\n  - Call the vendor today\n---\n- after rule line\n", ["Call the vendor today"]),
    # heading form wins even when the label form also exists
    ("### Plan\n- Book the venue now\n- Next Steps:\n- other item here\n",
     ["Book the venue now", "other item here"]),
    # empty heading section directly followed by a heading: the next heading's bullets are taken
    ("## Plan\n## Timeline\n- Book the venue for March\n", ["Book the venue for March"]),
    # numbered lines are not bullets
    ("## To-Do\n1. numbered entry here\n- dashed entry here\n", ["dashed entry here"]),
    # only the first heading section counts
    ("## Action Items\n- short\n## Next Steps\n- would be an item\n", []),
    # an empty bullet absorbs the next line
    ("## Plan\n- \n- absorbed line item\n", ["- absorbed line item"]),
    ("no sections at all\n- stray bullet item\n", []),
    ("## Planning notes\n- planning is another word\n", []),
]


@pytest.mark.parametrize("summary,items", ITEMS)
def test_action_items(spark, summary, items):
    assert one(spark, A.action_items("x"), summary) == items


ENTITY_CASES = [
    ("Acme (US) rocks", "Acme (US)", False),     # ')' then a space: no boundary after ')'
    ("Acme (US)x", "Acme (US)", True),
    ("I like C++ a lot", "C++", False),
    ("RED WIDGET shipped", "red widget", True),
    ("red widgets", "red widget", False),
    ("zoë inc said", "Zoë Inc", True),
    ("red widget\u0301 here", "red widget", True),  # combining mark after the name
    ("\u017fam h\u017fu", "Sam Hsu", True),          # long s folds to s
    ("\u212aelvin ltd", "Kelvin Ltd", True),          # Kelvin sign folds to k
    ("abc\\Edef", "abc\\Edef", True),                 # \E inside a name
    ("xred widget", "red widget", False),
]


def test_entity_boundaries_token_join(spark):
    docs = spark.createDataFrame([(str(i), t) for i, (t, _, _) in enumerate(ENTITY_CASES)], "doc_key string, text string")
    names = sorted({n for _, n, _ in ENTITY_CASES})
    ents = spark.createDataFrame([(n, "People", 1) for n in names], "name string, type string, type_rank int")
    hits = {(r["doc_key"], r["name"]) for r in EN.entity_mentions(docs, ents).collect()}
    for i, (_, name, hit) in enumerate(ENTITY_CASES):
        assert ((str(i), name) in hits) == hit, ENTITY_CASES[i]


def test_load_entities_first_type_wins(spark):
    src = spark.createDataFrame([("Acme Corp", "Companies"), ("ACME CORP", "Projects"), ("Ann", "People"),
                                 ("Zed Person", "People"), ("acme corp", "People"), ("Other", "Unknown")],
                                "name string, type string")
    got = sorted((r["name"], r["type"]) for r in EN.load_entities(src).collect())
    assert got == [("Zed Person", "People"), ("acme corp", "People")]


@pytest.mark.parametrize("summary,transcript,hit", [
    ("deal closed", "", True), ("it went live", "", True), ("now in production", "", True),
    ("the delivery is late", "", False), ("was deliv", "ered yesterday", True),
    ("nothing", "x" * 4100 + " shipped", False), ("nothing", "x" * 3000 + " shipped", True),
    ("LAUNCHED!", "", True), ("relaunched", "", False),
])
def test_delivery_signal(spark, summary, transcript, hit):
    df = spark.createDataFrame([(summary, transcript)], "s string, t string")
    cut = P.delivery_text("s", "t", vocab.DELIVERY_TRANSCRIPT_CHARS)  # the original's head
    assert df.select(delivery_signal(cut).alias("h")).collect()[0]["h"] == hit


REPLIES = [
    ('{"category": "Business", "confidence": 0.9, "reason": "ok"}', "Business", 0.9, "ok", None),
    ('```json\n{"category": "Learning", "confidence": 0.75}\n```', "Learning", 0.75, "", None),
    ('{"category": "Casual", "confidence": 0.', "Casual", 0.5, "JSON parse fallback", None),
    ("Business or Personal-Health", "Personal-Health", 0.5, "JSON parse fallback", None),
    ("no idea", "Business", 0.0, "unparseable: no idea", None),
    ('["Business"]', None, None, None, "not an object"),
    ('{"confidence": 0.4}', None, None, None, "no category"),
    ('{"category": 5}', None, None, None, "category not text"),
    ('{"category": "Casual", "confidence": null}', None, None, None, "confidence not numeric"),
    ('{"category": "Learning", "confidence": "0.7"}', "Learning", 0.7, "", None),
    ('{"category": "Learning", "confidence": true}', "Learning", 1.0, "", None),
    ('{"category": "Finance"}', "Finance", 0.0, "", None),
    ('{"category": "Casual", "reason": null}', "Casual", 0.0, "None", None),
    ('{"category": "Casual"} trailing', "Casual", 0.5, "JSON parse fallback", None),
    ("", "Business", 0.0, "unparseable: ", None),
]


def test_verdict_decode(spark):
    df = spark.createDataFrame([(str(i), r[0]) for i, r in enumerate(REPLIES)], "doc_key string, raw string")
    got = {r["doc_key"]: r for r in R.verdict_decode(df).collect()}
    for i, (_raw, cat, conf, reason, err) in enumerate(REPLIES):
        r = got[str(i)]
        assert r["error"] == err, (i, r)
        if err is None:
            assert (r["category"], r["reason"]) == (cat, reason), (i, r)
            assert r["confidence"] == pytest.approx(conf)


def test_enrich_pending_null_safe(spark):
    df = spark.createDataFrame([("untriaged",), ("routed",), ("enriched",), (None,), ("other",)], "status string")
    assert sorted(r["status"] or "" for r in enrich_pending(df).collect()) == ["", "other", "routed", "untriaged"]


def test_metadata_fields(spark):
    meta = "file x\n  name: Weekly sync\n  start_at: \n  created_at:  2024-05-06T07:08:09Z\n  duration: 5m\n"
    df = L.metadata_fields(spark.createDataFrame([(meta,), ("  start_at: x\n",)], "meta string"))
    r = df.collect()
    assert (r[0]["name"], r[0]["start_at"], r[0]["created_at"], r[0]["serial"], r[0]["meta_valid"]) == \
        ("Weekly sync", "", "2024-05-06T07:08:09Z", "", True)
    assert r[1]["meta_valid"] is False


def test_listing_ids(spark):
    h = "0123456789abcdef0123456789abcdef"
    lines = [(0, f"  {h}  title"), (1, f"\t{h}ff more"), (2, f"{h} not indented"), (3, "  " + h.upper()),
             (4, "  " + h[:31] + " short"), (5, "ID   NAME")]
    df = L.listing_ids(spark.createDataFrame(lines, "pos long, value string"))
    assert sorted((r["pos"], r["recording_id"]) for r in df.collect()) == [(0, h), (1, h + "ff")]
