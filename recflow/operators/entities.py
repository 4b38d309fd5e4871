"""Entity dictionary and whole-name mention matching at scale.

Matching every document against every entity regex is a nested-loop join.
Instead names and texts are cut into words, and the dictionary's words are looked
up in the texts once: an inverted index of (document, place, word), with the
separators around each word, of the words that some name holds.  A name is
anchored at the word of it that the fewest names hold (a shared last word like
"Holdings Ltd" is no anchor).  Where the index holds an anchor between the words that
stand beside it in the name, the name's further words are looked for at the places that
follow from it, by an equi-join on (document, place, word): a mention is a place where
all of them are found.  An anchor that is a common word makes no rows for names whose
other words aren't beside it, and no text is joined or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.text import NON_WORD, WORD, col, same_text
from recflow.operators.sketch import sketched
from recflow.session import stored


def fold(c) -> Column:
    """Case fold for keys: equal for any two texts a case-insensitive Unicode
    regex treats as equal (dotted capital I first, then lower, then upper;
    the translate between keeps Catalyst from collapsing lower/upper)."""
    x = F.lower(F.translate(col(c), "İ", "i"))
    # plain ASCII, which is most words, needs none of this
    return F.when(F.octet_length(col(c)) == F.length(col(c)), F.upper(col(c))).otherwise(F.upper(F.translate(x, "ſ", "s")))


def load_entities(src: DataFrame, types: list[str] = vocab.ENTITY_TYPES) -> DataFrame:
    """(name, type) -> (name, type, type_rank).

    Drops names of <= 3 characters; a case-insensitive name clash keeps the
    earliest type, then the smallest name.  Group-by with partial aggregation.
    """
    rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("type")).cast("int")
    e = (src.where(F.length("name") > vocab.ENTITY_MIN_LEN_EXCLUSIVE)
         .withColumn("type_rank", rank).where(F.col("type_rank") > 0))
    best = e.groupBy(F.lower("name").alias("_lname")).agg(
        F.min(F.struct("type_rank", "name", "type")).alias("_e"))
    return best.select(F.col("_e.name").alias("name"), F.col("_e.type").alias("type"),
                       F.col("_e.type_rank").alias("type_rank"))


def entity_union(frames: dict[str, DataFrame], name_col: str) -> DataFrame:
    """Union of per-type name tables into one (name, type) dictionary."""
    out = None
    for t, df in frames.items():
        part = df.select(F.col(name_col).alias("name"), F.lit(t).alias("type"))
        out = part if out is None else out.unionByName(part)
    return out


#: Keys of separators begin with this, so that none is a word's.
SEPARATOR = "\x00"


#: Up to this many words of the dictionary are sent to the tasks as they are.
SENT_WORDS = 100_000


def _words_of(df: DataFrame, who: list[str], text: str) -> DataFrame:
    """A row for each word: its place _no among the words, _part, and the separator _pre before it."""
    # both patterns end at the same words; what stands before a word is cut out of its piece
    # only for the rows that are kept, no pattern is met for a word
    pieces = F.regexp_extract_all(col(text), F.lit(f"{NON_WORD}*{WORD}+"), 0)
    cut = df.select(*who, pieces.alias("_pieces"), F.regexp_extract_all(col(text), F.lit(f"{WORD}+"), 0).alias("_parts"))
    # the inner form would be planned with a filter that cuts the text another time
    cut = cut.select(*who, "_pieces", F.posexplode_outer("_parts").alias("_no", "_part")).where(F.col("_part").isNotNull())
    piece = F.get("_pieces", F.col("_no"))
    return cut.select(*who, "_no", F.left(piece, F.length(piece) - F.length("_part")).alias("_pre"), "_part")


def _mark() -> Column:
    """15 bits of a row's word, by which nearly all other words are told from it (null for a separator)."""
    return F.when(F.col("_part").isNotNull(), F.hash("_key").bitwiseAND(F.lit(0x7FFF)))


def name_words(entities: DataFrame) -> DataFrame:
    """What a text must hold for a name, a row for each word, and one for the separator that a
    name ends with or consists of: name, _no, _pre, _part (null for a separator), _key, _words
    (the name's rows), _anchor (whether it is the row whose key the fewest names hold), and
    for an anchor the marks of the name's words _before and _after it (null if none)."""
    names = entities.where(F.length("name") > 0).select("name").distinct()
    tail = F.regexp_extract("name", rf"({NON_WORD}*)\z", 1)
    ends = (names.withColumn("_pre", tail).where(F.length("_pre") > 0)
            .select("name", F.regexp_count("name", F.lit(f"{WORD}+")).alias("_no"), "_pre", F.lit(None).cast("string").alias("_part"),
                    F.concat(F.lit(SEPARATOR), fold("_pre")).alias("_key")))
    rows = _words_of(names, ["name"], "name").withColumn("_key", fold("_part")).unionByName(ends)
    spread = rows.select("name", "_key").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("_names"))
    counted = rows.join(spread, "_key")
    marks = F.map_from_entries(F.collect_list(F.when(F.col("_part").isNotNull(), F.struct("_no", _mark()))))
    best = counted.groupBy("name").agg(F.count(F.lit(1)).alias("_words"), F.min(F.struct(
        F.col("_part").isNull().alias("_last"), "_names", (-F.length("_key")).alias("_short"), "_no")).alias("_best"), marks.alias("_marks"))
    anchor = F.col("_no") == F.col("_best._no")
    return (counted.join(best, "name").withColumn("_anchor", anchor)
            .select("name", "_no", "_pre", "_part", "_key", "_words", "_anchor",
                    F.when(anchor, F.col("_marks")[F.col("_no") - 1]).alias("_before"),
                    F.when(anchor, F.col("_marks")[F.col("_no") + 1]).alias("_after")))


def word_index(docs: DataFrame, words: DataFrame, key: str = "doc_key", text: str = "text") -> DataFrame:
    """The places in the texts of what some name needs (``name_words``): words, and the
    separators between two words that a name ends with.  Other words go where the texts are
    read: none is shuffled, but for those that a sketch of a large dictionary passes by chance."""
    placed = _words_of(docs.select(col(key).alias("_doc"), col(text).alias("_text")), ["_doc"], "_text")
    keys = words.select("_key").distinct()
    no_part = F.col("_part").isNull()
    size = words.agg(F.count_if(no_part).alias("separators"), F.count_if(no_part & (F.col("_pre") == " ")).alias("blank"),
                     F.count_distinct("_key").alias("keys")).first()
    if size["separators"]:  # few names end with a separator, next to none with a blank
        between = F.col("_no") > 0
        if not size["blank"]:
            between = between & (F.col("_pre") != " ")
        both = F.array(F.struct("_part", fold("_part").alias("_key")),
                       F.struct(F.lit(None).cast("string").alias("_part"), F.concat(F.lit(SEPARATOR), fold("_pre")).alias("_key")))
        placed = placed.select("_doc", "_no", "_pre", F.inline(F.when(between, both).otherwise(F.slice(both, 1, 1))))
    else:
        # never null, as the joins would otherwise fold each word once more to see that it is not
        placed = placed.withColumn("_key", F.coalesce(fold("_part"), F.lit("")))
    if size["keys"] <= SENT_WORDS:
        return placed.join(F.broadcast(keys), "_key", "left_semi")
    # an inner join with the distinct keys: a semi join would be planned below the sketch
    return sketched(placed, keys, "_key", size["keys"]).join(keys, "_key")


def _stands(index: str = "i", word: str = "w") -> Column:
    """Whether a place of the index holds what a name needs there: the same letters, behind
    the name's separator.  Within a name that is the whole separator; where a name begins with
    one, a further word stands before it, as whole names require."""
    at = lambda side, c: F.col(f"{side}.{c}")
    pre = at(word, "_pre")
    behind = ((at(word, "_no") == 0) & (pre == "")) | (same_text(at(index, "_pre"), pre) & (at(index, "_no") > 0))
    return behind & (at(word, "_part").isNull() | same_text(at(index, "_part"), at(word, "_part")))


def candidate_places(index: DataFrame, words: DataFrame) -> DataFrame:
    """(_doc, name, _start, _words): where a name's anchor stands between the words that the
    name has beside it (as far as their marks tell), the place of its first word.  The words
    beside a place are looked up in the index, document by document."""
    by_place = Window.partitionBy("_doc").orderBy("_no")
    index = index.withColumns({c: F.collect_set(_mark()).over(by_place.rangeBetween(step, step))
                               for c, step in (("_before", -1), ("_after", 1))})
    found = index.alias("i").join(words.where("_anchor").alias("w"), F.col("i._key") == F.col("w._key")).where(_stands())
    for c in ("_before", "_after"):
        found = found.where(F.col(f"w.{c}").isNull() | F.array_contains(f"i.{c}", F.col(f"w.{c}")))
    return found.select("i._doc", "w.name", (F.col("i._no") - F.col("w._no")).alias("_start"), "w._words")


def entity_mentions(docs: DataFrame, entities: DataFrame, key: str = "doc_key",
                    text: str = "text") -> DataFrame:
    """(key, text) x (name, type, type_rank) -> one row per (document, entity hit).

    The index is written to the shared folder, as both joins read it."""
    words = stored(name_words(entities), "name-words")
    index = stored(word_index(docs, words, key, text), "word-index")
    places = candidate_places(index, words)
    whole = places.where("_words = 1").select("_doc", "name")
    # each further word of a name is expected at one place; all of them must be found
    expected = (places.where("_words > 1").distinct().join(words.where("NOT _anchor").drop("_words"), "name")
                .withColumn("_at", F.col("_start") + F.col("_no")))
    met = (index.alias("i").join(expected.alias("w"), (F.col("i._doc") == F.col("w._doc")) & (F.col("i._no") == F.col("w._at"))
                                 & (F.col("i._key") == F.col("w._key"))).where(_stands()))
    longer = (met.groupBy("w._doc", "w.name", "w._start", "w._words").agg(F.count(F.lit(1)).alias("_met"))
              .where(F.col("_met") + 1 == F.col("_words")).select("_doc", "name"))
    hits = whole.unionByName(longer).distinct()
    return hits.join(entities, "name").select(F.col("_doc").alias(key), "name", "type", "type_rank")


def company_hits(mentions: DataFrame) -> DataFrame:
    return mentions.where(F.col("type") == "Companies")


def mention_list(mentions: DataFrame, key: str = "doc_key", alias: str = "entity_names") -> DataFrame:
    """Entity names per document in dictionary order (type, then name)."""
    return (mentions.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("type_rank", "name"))).alias("_m"))
            .select(key, F.transform("_m", lambda x: x["name"]).alias(alias)))
