"""Problem 7: encoding of a corpus with a public byte-level BPE vocabulary, in Spark's higher-order functions.

A text is cut into words by the vocabulary's pattern. Words that are themselves a piece of the vocabulary
(most occurrences) get its id where they stand. Other words are encoded by a fold: an aggregate() over the array of a
word's bytes, each as its id, merges the adjacent pair of least rank, leftmost first, until none is left. The ranks are one
literal: the pairs of neighbouring ids and what they make, as text in buckets, so that a look-up searches a short text.

The FREQUENT most frequent of the distinct other words are folded once and sent as a literal; the rest occur seldom
and are folded where they stand. So no text and no list of ids is ever shuffled, only counts of distinct words.
The literals have the size of the vocabulary file and of FREQUENT words, which no corpus changes.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's makers cut text into words. (?U) gives \s its Unicode meaning.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS = 8192
#: Longer words (bytes) leave the fold, whose work grows with the square of a word's length, for a heap.
LONG_WORD = 512
#: Words that are no piece, folded once and sent along: so many at most, of so many bytes at most (below 2 MB in all), that occur so often at least.
FREQUENT, FREQUENT_BYTES, LEAST_USES = 20_000, 64, 4


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """piece -> id (its rank) from a file of lines `base64 rank`."""
    lines = Path(path).read_bytes().split(b"\n")
    return {base64.b64decode(a): int(b) for a, _, b in (x.partition(b" ") for x in lines if x.strip())}


class Vocabulary:
    """The literals that the expressions below look pieces and ids up in."""

    def __init__(self, path: str = VOCABULARY):
        self.ranks = read_vocabulary(path)
        texts: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
        pieces: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        pairs: list[list[str]] = [[] for _ in range(BUCKETS)]  # few objects: every task reads its literals anew
        for piece, i in self.ranks.items():
            pieces[i] = base64.b64encode(piece).decode()
            try:
                texts[zlib.crc32(piece) % BUCKETS][piece.decode()] = i
            except UnicodeDecodeError:
                pass  # no whole word has these bytes
            for at in range(1, len(piece)):
                a, b = self.ranks.get(piece[:at]), self.ranks.get(piece[at:])
                if a is not None and b is not None:
                    pairs[(a * SPREAD + b) % BUCKETS].append(f";{a},{b}={i:0{DIGITS}d}")
        single = [self.ranks.get(bytes([i])) for i in range(256)]
        self._literals = {k: json.dumps(v, separators=(",", ":")) for k, v in {
            "texts": texts, "pieces": pieces, "pairs": ["".join(x) for x in pairs], "bytes": single,
        }.items()}

    def literal(self, name: str, kind: str) -> Column:
        """The optimizer folds it to one literal."""
        return F.from_json(F.lit(self._literals[name]), kind)

    def texts(self) -> Column:
        return self.literal("texts", "array<map<string,int>>")

    def pieces(self) -> Column:
        return self.literal("pieces", "array<binary>")

    def pairs(self) -> Column:
        """struct of pairs and bytes."""
        return F.struct(self.literal("pairs", "array<string>").alias("pairs"), self.literal("bytes", "array<int>").alias("bytes"))


#: Spreads pairs of ids over the buckets; digits of an id in them.
SPREAD, DIGITS = 7919, 6


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that stands in the plan once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def looked_up(maps: Column, word: Column) -> Column:
    """The value of a word in maps that its checksum chooses among, null if it is not there."""
    return F.element_at(F.get(maps, F.pmod(F.crc32(word.cast("binary")), F.lit(BUCKETS)).cast("int")), word)


def merged_id(ranks: Column, a: Column, b: Column) -> Column:
    """The id (and so the rank) of the piece that two neighbouring ids make, null if they make none or either is null."""
    bucket = F.get(ranks["pairs"], F.pmod(a.cast("bigint") * SPREAD + b, F.lit(BUCKETS)).cast("int"))
    key = F.concat(F.lit(";"), a.cast("string"), F.lit(","), b.cast("string"), F.lit("="))
    found = F.call_function("substring_index", bucket, key, F.lit(-1))  # all that follows the pair, or the whole bucket
    return F.when(F.length(found) < F.length(bucket), F.left(found, F.lit(DIGITS)).cast("int"))


def merged(ranks: Column, word: Column) -> Column:
    """The ids of a word's bytes (binary): a fold that merges the pair of least rank at each step."""

    def digit(hexed: Column, i: Column) -> Column:
        c = F.ascii(F.substring(hexed, i, F.lit(1)))
        return c - F.when(c > 57, F.lit(55)).otherwise(F.lit(48))

    n = F.octet_length(word)
    bytes_ = let(F.hex(word), lambda h: F.transform(F.sequence(F.lit(1), n), lambda i: F.get(ranks["bytes"], digit(h, 2 * i - 1) * 16 + digit(h, 2 * i))))

    def step(acc: Column, _: Column) -> Column:
        p, r = acc["p"], acc["r"]
        k = F.coalesce(F.array_position(r, F.array_min(r)), F.lit(0)).cast("int")  # leftmost of least rank; 0: none is left
        new = F.array_min(r)
        rest = F.size(p)
        before = F.when(k > 1, merged_id(ranks, F.get(p, k - 2), new))
        after = merged_id(ranks, new, F.get(p, k + 1))
        ids = F.concat(F.slice(p, F.lit(1), k - 1), F.array(new), F.slice(p, k + 2, rest))
        left = F.when(k > 1, F.concat(F.slice(r, F.lit(1), F.greatest(k - 2, F.lit(0))), F.array(before))).otherwise(F.slice(r, F.lit(1), F.lit(0)))
        return F.when(k == 0, acc).otherwise(F.struct(ids.alias("p"), F.concat(left, F.array(after), F.slice(r, k + 2, rest)).alias("r")))

    def folded(ids: Column) -> Column:
        ranked = F.transform(ids, lambda x, i: merged_id(ranks, x, F.get(ids, i + 1)))
        return F.aggregate(ids, F.struct(ids.alias("p"), ranked.alias("r")), step)["p"]

    return let(bytes_, folded)


def heap_merge(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The same ids by a heap of pairs, for very long words."""
    n = len(word)
    piece = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n)) + [-1], [-1, *range(n - 1)]
    heap = [(ranks[word[i : i + 2]], i, 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if piece[i] else -1
        if j < 0 or len(piece[i]) + len(piece[j]) != size:
            continue
        piece[i], piece[j] = piece[i] + piece[j], b""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            b = after[a] if a >= 0 else -1
            if b >= 0 and (rank := ranks.get(piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (rank, a, len(piece[a]) + len(piece[b])))
    return [ranks[p] for p in piece if p]


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """word (text, not empty) -> word, ids."""
    few = F.octet_length("word") <= LONG_WORD
    short = words.where(few).select("word", let(vocabulary.pairs(), lambda ranks: merged(ranks, F.col("word").cast("binary"))).alias("ids"))
    ranks = vocabulary.ranks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"word": pdf["word"], "ids": [heap_merge(ranks, w.encode()) for w in pdf["word"]]})

    long = words.where(~few).mapInPandas(run, "word string, ids array<int>")
    return short.unionByName(long)


def frequent_words(waiting: DataFrame, vocabulary: Vocabulary) -> Column:
    """array<map<string,array<int>>>: the ids of the words (column word) that occur most, folded once; bounded by FREQUENT and FREQUENT_BYTES."""
    counts = waiting.where(F.octet_length("word") <= FREQUENT_BYTES).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= LEAST_USES).orderBy(F.desc("n"), "word").limit(FREQUENT).select("word")
    maps: list[dict[str, list[int]]] = [{} for _ in range(BUCKETS)]
    for r in encode_words(top, vocabulary).collect():
        maps[zlib.crc32(r.word.encode()) % BUCKETS][r.word] = r.ids
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,array<int>>>")


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text without special tokens; an empty list for null and for empty texts.

    doc_id must be unique. Strings of special tokens in a text are ordinary text. Other columns are not read.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(PATTERN), F.lit(0))
    # of every word its id or, where it is no piece, the word itself
    known = let(vocabulary.texts(), lambda maps: let(words, lambda ws: let(
        F.transform(ws, lambda w: looked_up(maps, w)),
        lambda ids: F.struct(ids.alias("known"), F.transform(ws, lambda w, i: F.when(F.get(ids, i).isNull(), w)).alias("rest")),
    )))
    is_long = lambda w: F.octet_length(w) > LONG_WORD
    cut = docs.select(F.col(id_col).alias("doc_id"), known.alias("x")).select("doc_id", "x.known", "x.rest")
    cut = written(cut.withColumn("long", F.exists("rest", lambda w: F.coalesce(is_long(w), F.lit(False)))), "words")
    often = frequent_words(cut.select(F.explode("rest").alias("word")).where("word IS NOT NULL"), vocabulary)

    def coded(rows: DataFrame, of_long: Callable[[Column], Column]) -> DataFrame:
        def ids(often_: Column, ranks: Column) -> Column:
            other = lambda w, i: F.when(is_long(w), of_long(i)).otherwise(F.coalesce(looked_up(often_, w), merged(ranks, w.cast("binary"))))
            return F.flatten(F.transform("known", lambda x, i: F.when(x.isNotNull(), F.array(x)).otherwise(let(F.get(F.col("rest"), i), lambda w: other(w, i)))))

        return rows.select("doc_id", let(often, lambda o: let(vocabulary.pairs(), lambda r: ids(o, r))).alias("ids"))

    has_long = cut.where("long")
    if not has_long.take(1):
        return coded(cut, lambda i: F.lit(None).cast("array<int>"))
    # very long words are encoded once each and joined back by their place; no other text is moved for them
    places = has_long.select("doc_id", F.posexplode("rest").alias("pos", "word")).where(is_long(F.col("word")))
    found = places.join(encode_words(places.select("word").distinct(), vocabulary), "word")
    more = found.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ids"))).alias("more"))
    short = coded(cut.where("NOT long"), lambda i: F.lit(None).cast("array<int>"))
    return short.unionByName(coded(has_long.join(more, "doc_id"), lambda i: F.element_at("more", i)))


def joined_pieces(pieces: Column) -> Column:
    """The bytes of an array of pieces in one: neighbours are joined sixty-four at a time, level by level, so the work grows with the length."""
    nothing = F.unhex(F.lit(""))
    for _ in range(5):
        groups = lambda p: F.when(F.size(p) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(p) - 1) / 64).cast("int")),
            lambda j: F.aggregate(F.slice(p, j * 64 + 1, F.lit(64)), nothing, lambda acc, x: F.concat(acc, x)),
        ))
        pieces = let(pieces, groups)
    return F.coalesce(F.get(pieces, F.lit(0)), nothing)


def decode(vocabulary: Vocabulary, ids: Column) -> Column:
    """The text of a column of ids: its binary pieces joined and read as UTF-8."""
    return F.decode(let(vocabulary.pieces(), lambda pieces: joined_pieces(F.transform(ids, lambda i: F.get(pieces, i)))), "UTF-8")
