"""BPE encoding and decoding by a prefix-sharing trie traversal.

The last token of the encoding of a prefix fixes the rest of it: token t ends a prefix if
the encoding of what precedes t ends in a token that t can follow, and exactly one does.
The distinct words of a batch, sorted, are the depth-first order of their trie; the walk
keeps the last-token states of the current path, and a word goes on from the states of the
prefix that it shares with the word before it.  Which tokens can follow each other comes
from the merge ranks along their facing edges, once for each pair met.

Normalisation and word splitting follow the vocabulary file: NFC, lower case, white space
dropped; special tokens in the raw text are taken as such.  Texts are processed in chunks
by Arrow batches in place: nothing is shuffled.  Defined results: null and empty texts have
no tokens; whole texts of any length are encoded; rows are independent of each other.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm.common import ship, text_of

ship(__name__)

END = "</w>"
#: Words whose encodings a task remembers; characters encoded at a time; pairs of tokens whose
#: answer it remembers.  They bound a worker's memory, whatever the texts.
REMEMBERED, CHUNK_CHARS, PAIRS = 80_000, 500_000, 200_000

# The word pattern of the vocabulary file, with the white space of the common
# alphabets spelt out (the library splits texts that hold any other).
_SPACE = r"\t-\r \x85\xa0"
_PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+"


_SHORT = (2, 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Tables of a word-end BPE file: byte strings of tokens, and the merges along their edges."""

    def __init__(self, content: str):
        model = json.loads(content)
        self._content, self._library = content, None
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids = model["model"]["vocab"]
        self.strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.specials.items()}
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.length: dict[int, int] = {}
        self.rank: dict[int, int] = {}  # by both tokens, a << 20 | b
        parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["model"]["merges"]):
            self.rank[ids[a] << 20 | ids[b]] = rank
            parts[ids[a + b]] = (ids[a], ids[b])
        self.parts = parts
        self.follows: dict[int, bool] = {}
        whole: dict[int, bool] = {}
        for s, t in sorted(ids.items(), key=lambda x: len(x[0].removesuffix(END))):
            whole[t] = t not in parts or (whole[parts[t][0]] and whole[parts[t][1]] and not self.crosses(*parts[t], but=self.rank[parts[t][0] << 20 | parts[t][1]]))
            ends = s.endswith(END) and s != END
            raw = bytes(byte_of[c] for c in (s.removesuffix(END) if ends else s))
            self.length[t] = len(raw)
            if whole[t]:
                (self.final if ends else self.inner)[raw] = t
        self.inner_lengths = self._lengths(self.inner)
        self.final_lengths = self._lengths(self.final)

    @staticmethod
    def _lengths(tokens: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
        """Lengths of the tokens that end in these three bytes (or are these one or two),
        longest first: what may end a prefix that ends so."""
        found: dict[bytes, set] = {}
        for raw in tokens:
            found.setdefault(raw[-3:], set()).add(len(raw))
        tails = {raw[-3:] for raw in tokens if len(raw) > 2}
        for tail in tails:
            found[tail] |= {1} | ({2} if tail[1:] in tokens else set())
        for tail in [t for t in found if len(t) == 2]:
            found[tail] |= {1}
        return {tail: tuple(sorted(lengths, reverse=True)) for tail, lengths in found.items()}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens along one edge of a token (side 1: its end, 0: its start), outermost
        first, each with the rank of the merge that uses it up."""
        found, gone = [], len(self.parts) + 1
        while True:
            found.append((token, gone))
            if token not in self.parts:
                return found
            a, b = self.parts[token]
            gone, token = self.rank[a << 20 | b], (a, b)[side]

    def crosses(self, a: int, b: int, but: int = -1) -> bool:
        """Whether a merge joins the end of a with the start of b before their own merges
        use these parts up; at equal rank the merge further left comes first."""
        start = self.edge(b, 0)
        for x, x_gone in self.edge(a, 1):
            for y, y_gone in start:
                rank = self.rank.get(x << 20 | y)
                if rank is not None and rank != but and rank < x_gone and rank <= y_gone:
                    return True
        return False

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self._content)
        return self._library

    def can_follow(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > PAIRS:
                self.follows.clear()
            known = self.follows[key] = not self.crosses(a, b)
        return known

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) in the depth-first order of the words' trie.

        ``states[k]`` is the last token of the encoding of the path's first k bytes; a word
        keeps the states that it shares with the one before it."""
        path, states = b"", [0]
        follows, can_follow, length = self.follows, self.can_follow, self.length
        inner, inner_lengths = self.inner, self.inner_lengths
        final, final_lengths = self.final, self.final_lengths
        for raw, word in sorted([(w.encode("utf-8"), w) for w in words]):
            n = len(raw)
            shared = 0
            most = min(len(path), n - 1)
            while shared < most and path[shared] == raw[shared]:
                shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, n + 1):
                tokens, lengths = (inner, inner_lengths) if end < n else (final, final_lengths)
                # no token of three or more ends in an unknown tail, but one of two or one may
                for size in lengths.get(raw[end - 3:end] if end > 2 else raw[:end], _SHORT):
                    start = end - size
                    if start < 0:
                        continue
                    t = tokens.get(raw[start:end])
                    if t is None:
                        continue
                    if not start:
                        break
                    known = follows.get(states[start] << 20 | t)
                    if known or known is None and can_follow(states[start], t):
                        break
                states.append(t)
            path = raw[:-1]
            at, ids = n, []
            while at:
                t = states[at]
                ids.append(t)
                at -= length[t]
            states.pop()
            yield word, ids[::-1]

    def decode(self, ids) -> str:
        """The library's decoding for a file without a decoder: token strings joined by blanks."""
        return " ".join([self.strings[i] for i in ids])


def splitter(vocabulary: Vocabulary):
    """Function from a text to its words, special tokens among them as they stand.

    Texts beyond the common alphabets are normalised and split by the library itself, as
    Unicode tables differ between versions in recently assigned characters."""
    special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.specials)) + ")") if vocabulary.specials else None
    piece = regex.compile(_PIECE)
    uncommon = re.compile("[^\x00-\u052f\u1e00-\u1fff\u2010-\u2027\u20ac\u3041-\u3096\u4e00-\u9fa5]")
    byte_of = {c: b for b, c in enumerate(byte_symbols())}

    def words(text: str) -> list[str]:
        if not text.isascii():
            if uncommon.search(text):
                library = vocabulary.library()
                found = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
                return [bytes(map(byte_of.__getitem__, w)).decode("utf-8") for w, _ in found]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return piece.findall(text.lower())

    def split(text: str) -> list[str]:
        if special is None or "<|" not in text:
            return words(text)
        out: list[str] = []
        for k, part in enumerate(special.split(text)):
            out += [part] if k % 2 else words(part)
        return out

    return split


class Words:
    """Encodings of words.  What a chunk of texts needs is encoded together; afterwards only
    words that the chunk before had to encode as well are remembered, as most words are rare."""

    def __init__(self, vocabulary: Vocabulary, value):
        self.vocabulary, self.value = vocabulary, value
        self.split = splitter(vocabulary)
        self.known: dict = {}
        self.before: set[str] = set()

    def chunk(self, texts: list[str]) -> Iterator[list]:
        """The values of each text's words."""
        known, pieces = self.known, [self.split(t) for t in texts]
        if len(known) > REMEMBERED:
            known.clear()
        new = set().union(*pieces) - known.keys()
        special = {s: self.value([i]) for s, i in self.vocabulary.specials.items() if s in new}
        known.update((w, self.value(ids)) for w, ids in self.vocabulary.encode_words([w for w in new if w not in special]))
        known.update(special)
        for words in pieces:
            yield [known[w] for w in words]
        for w in new - self.before:
            del known[w]
        self.before = new

    def all(self, texts: Iterator[str]) -> Iterator[list]:
        part, chars = [], 0
        for text in texts:
            part.append(text)
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self.chunk(part)
                part, chars = [], 0
        yield from self.chunk(part)


def encode_texts(vocabulary: Vocabulary, texts: Iterator[str], words: Words | None = None) -> Iterator[list[int]]:
    """Token ids of each text; distinct words of a chunk of texts are encoded together."""
    words = Words(vocabulary, lambda ids: ids) if words is None else words
    for values in words.all(texts):
        yield [i for ids in values for i in ids]


def _held(content, name: str, make):
    """Made once for each Python worker: a worker process holds a broadcast for all its tasks."""
    if not hasattr(content, name):
        setattr(content, name, make())
    return getattr(content, name)


def _words(content, name: str, value) -> Words:
    vocabulary = _held(content, "vocabulary", lambda: Vocabulary(content.value))
    return _held(content, name, lambda: Words(vocabulary, value(vocabulary)))


def _texts(batch: pa.Array) -> Iterator[str]:
    """One text at a time: a batch stays in Arrow's form."""
    return (x.as_py() for x in batch)


def digester(content):
    """Struct of n_tokens, ids_sha256, decoded_sha256 for whole texts; ``content`` is a
    broadcast of the vocabulary file."""
    def both(vocabulary):
        def value(ids):
            packed = array("I", ids)
            return packed.tobytes(), vocabulary.decode(packed)
        return value

    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _words(content, "digests", both)
        for batch in batches:
            counts, ids_digests, decoded_digests = [], [], []
            for found in words.all(_texts(batch)):
                ids = b"".join([x[0] for x in found])
                counts.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                decoded_digests.append(hashlib.sha256(" ".join([x[1] for x in found]).encode("utf-8")).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()),
                                              pa.array(decoded_digests, pa.string())],
                                             names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.arrow_udf(digest, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokeniser(content):
    """Array of token ids for whole texts."""
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _words(content, "ids", lambda vocabulary: lambda ids: ids)
        for batch in batches:
            yield pa.array(list(encode_texts(words.vocabulary, _texts(batch), words)), pa.list_(pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def vocabulary_file(spark: SparkSession, path: str | None = None):
    """The vocabulary file (a few MB, whatever the corpus) as a broadcast."""
    with open(path or default_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids``."""
    return docs.withColumn("token_ids", tokeniser(vocabulary_file(docs.sparkSession, path))(text_of(text_col)))


def decoded(ids: Column, content) -> Column:
    """Text of an array of ids."""
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _held(content, "vocabulary", lambda: Vocabulary(content.value))
        for batch in batches:
            yield pa.array([vocabulary.decode(x.as_py()) for x in batch], pa.string())

    return F.arrow_udf(decode, "string")(ids)


def digests(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with the struct ``_tokens``: n_tokens, ids_sha256, decoded_sha256."""
    return docs.withColumn("_tokens", digester(vocabulary_file(docs.sparkSession, path))(text_of(text_col)))
