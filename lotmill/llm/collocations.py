"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

A pass for each length of prefix, from none to three words, reads whole texts in blocks of some ``BLOCK_CHARS`` signs.  A block
counts the words after each prefix and sends one stripe a prefix: its next words and their counts.  Stripes of a prefix meet
in one task and are merged word by word.  An entry of a merged stripe is an extension's count; a count is at once the total
of the next, longer prefix; and the largest entries of a stripe, and of the entries that end alike, tell what holds a phrase.

A phrase that is frequent has frequent parts only, so a pass skips each place whose prefix, or whose last words, were rare in
the pass before.  These are known from a Bloom filter of at most ``MAX_FILTER_BITS`` over the frequent phrases; where it is
full, more stripes travel, and none is lost.  A prefix that holds more than 1 / ``PARTS`` of all words has its stripe cut by
next words into as many parts as that share asks for: there are at most ``PARTS`` such prefixes, and none is a hot task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import A_TO_Z, release_memory, stage_table, text_or_empty

MIN_COUNT = 30
TOP = 2000
MAX_WORDS = 4
#: A phrase goes where a longer one holds at least so many hundredths of its occurrences.
HELD = 80
BLOCK_CHARS = 6 << 20
SLICE_CHARS = 1 << 20
MAX_FILTER_BITS = 2**29
BITS_PER_PHRASE = 16
PARTS = 1024
#: Bits of one bitmap of Spark's.
BITMAP = 32_768
BREAKS = ".,;:!?\x0b\x0c\r"
#: A stripe travels as one text: its next words, with a tab and the count behind those that come more than once.
STRIPES = "lang string, prefix string, part int, nexts string"


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(langs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64 bits of each word in its language; both as object arrays of texts."""
    return _joined(pd.util.hash_array(langs), pd.util.hash_array(words, categorize=False))


class Words(NamedTuple):
    """Words of a block by number: their languages, as places in ``langs``, and texts."""

    langs: list[str]
    lang: np.ndarray
    texts: pa.Array

    def hashes(self) -> np.ndarray:
        if not len(self.lang):
            return np.zeros(1, np.uint64)
        of_lang = pd.util.hash_array(np.array(self.langs, object))
        return np.append(_joined(of_lang[self.lang], pd.util.hash_array(self.texts.to_numpy(zero_copy_only=False), categorize=False)), np.uint64(0))


def _joined(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mixed(phrase * np.uint64(0x9E3779B97F4A7C15) + word)


def phrase_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words at each place of a run of word hashes."""
    places = max(0, len(hashes) - size + 1)
    out = hashes[:places]
    for k in range(1, size):
        out = _joined(out, hashes[k : k + places])
    return out


class PhraseFilter:
    """Bloom filter with two slots a phrase."""

    def __init__(self, bits: int, data: np.ndarray) -> None:
        self.bits, self.data = bits, data

    @staticmethod
    def slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(bits - 1)
        return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self.slots(hashes, self.bits)
        return ((self.data[a >> 3] >> (a & 7)) & (self.data[b >> 3] >> (b & 7)) & 1).astype(bool)


def phrase_filter(phrases: DataFrame, size: int, max_filter_bits: int) -> PhraseFilter:
    """Filter of the phrases of ``size`` words in columns ``lang`` and ``phrase``; the driver holds its bits only."""
    bits = min(1 << max(15, (phrases.count() * BITS_PER_PHRASE).bit_length()), max_filter_bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = batch.column(0).to_pylist(), pc.split_pattern(batch.column(1), " ").flatten().to_numpy(zero_copy_only=False)
            if not len(words):
                continue
            flat = word_hashes(np.repeat(np.array(langs, object), size), words)
            slots = np.concatenate(PhraseFilter.slots(phrase_hashes(flat, size)[::size], bits))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(slots) + 1)], names=["slot"])  # Spark's bitmaps count from 1

    slot = F.col("slot")
    bitmaps = phrases.select("lang", "phrase").mapInArrow(work, "slot long").groupBy(F.call_function("bitmap_bucket_number", slot).alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", slot)).alias("bitmap")
    )
    data = np.zeros(bits // 8, np.uint8)
    for r in bitmaps.collect():
        at = (r.bucket - 1) * BITMAP // 8
        data[at : at + len(r.bitmap)] = np.frombuffer(r.bitmap, np.uint8)
    return PhraseFilter(bits, data)


def _slices(text: str) -> Iterator[str]:
    """A text in parts of bounded length, cut at a space."""
    start = 0
    while len(text) - start > SLICE_CHARS:
        cut = text.rfind(" ", start, start + SLICE_CHARS)
        cut = text.find(" ", start + SLICE_CHARS) if cut <= start else cut
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:] if start else text


def _numbered(langs: list[str], pieces: list[str]) -> tuple[Words, np.ndarray]:
    """Words of pieces of text, told apart by language, and the number of the word at each place; a break is -1."""
    tokens = pc.split_pattern(pc.replace_substring(pa.array(pieces, pa.string()), "\n", " \n "), " ")
    names = {g: k for k, g in enumerate(dict.fromkeys(langs))}
    lang = np.repeat(np.array([names[g] for g in langs], np.int64), np.asarray(tokens.value_lengths()))
    encoded = tokens.flatten().dictionary_encode()
    number, texts = np.asarray(encoded.indices).astype(np.int64), encoded.dictionary
    blank, cut = (np.asarray(pc.equal(texts, t)) for t in ("", "\n"))
    kind = np.where(blank, -2, np.where(cut, -1, 0))[number]
    lang, number, kind = (x[kind > -2] for x in (lang, number, kind))
    both = lang * len(texts) + number
    used, ids = np.unique(both[kind == 0], return_inverse=True) if len(names) * len(texts) > 1 << 26 else _dense(both[kind == 0], len(names) * len(texts))
    places = np.full(len(kind), -1, np.int64)
    places[kind == 0] = ids
    size = max(1, len(texts))
    return Words(list(names), used // size, texts.take(pa.array(used % size))), places


def _dense(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the place of each code among them."""
    there = np.zeros(size, bool)
    there[codes] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[codes]


def blocks(batches: Iterator[pa.RecordBatch], prefix: int) -> Iterator[tuple[Words, np.ndarray]]:
    """Words and word numbers by place, of a bounded length of text at a time; windows of ``prefix`` + 1 words lie in one block each."""
    langs, pieces, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part in (*_slices(text), "\n"):
                langs.append(lang)
                pieces.append(part)
                held += len(part)
                if held >= BLOCK_CHARS:
                    words, places = _numbered(langs, pieces)
                    yield words, places
                    last = places[len(places) - prefix :] if prefix else places[:0]
                    last = last[np.flatnonzero(np.append(-1, last) < 0)[-1] :].tolist()  # words since the last break: a window may go on
                    langs, pieces, held = [lang], [" ".join(words.texts[k].as_py() for k in last)], 0
    if pieces:
        yield _numbered(langs, pieces)


def _counted(spans: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct windows in the order of their prefixes: a number for each prefix, their words by place, and their counts."""
    used = np.unique(np.concatenate(spans))
    size = max(1, len(used))
    if size ** len(spans) < 2**63:  # a window is one number
        code = reduce(lambda whole, word: whole * size + word, (np.searchsorted(used, s) for s in spans))
        code, counts = np.unique(code, return_counts=True)
        group, left, words = code // size, code, []
        for _ in spans:
            left, word = np.divmod(left, size)
            words.append(used[word] if len(used) else word)
        return group, words[::-1], counts
    group = spans[0]
    for s in spans[1:-1]:
        group = np.unique(group * (used[-1] + 1) + s, return_inverse=True)[1]
    code, first, counts = np.unique(group * (used[-1] + 1) + spans[-1], return_index=True, return_counts=True)
    return code // (used[-1] + 1), [s[first] for s in spans], counts


def _parts(prefix: list[np.ndarray], nexts: np.ndarray, hashes: np.ndarray, hot: dict[int, int]) -> np.ndarray:
    """Part of each entry: by its next word where there is no prefix or a hot one."""
    if not prefix:
        return (_mixed(hashes[nexts]) % np.uint64(PARTS)).astype(np.int64)
    if not hot or not len(nexts):
        return np.zeros(len(nexts), np.int64)
    keys = np.sort(np.fromiter(hot, np.uint64, len(hot)))
    cut = np.array([hot[int(k)] for k in keys], np.uint64)
    mine = reduce(_joined, (hashes[w] for w in prefix))
    where = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
    return np.where(keys[where] == mine, _mixed(hashes[nexts]) % cut[where], 0).astype(np.int64)


def stripes_of(words: Words, ids: np.ndarray, prefix: int, known: PhraseFilter | None, hot: dict[int, int]) -> pa.RecordBatch:
    """Stripes of a block: for each prefix, and each part of it, its next words and their counts."""
    hashes = words.hashes()
    if prefix:
        spans, unbroken = max(0, len(ids) - prefix + 1), ids >= 0
        good = reduce(np.logical_and, (unbroken[k : k + spans] for k in range(prefix)))
        good[good] = known.holds(phrase_hashes(hashes[ids], prefix)[good])
        at = np.flatnonzero(good[:-1] & good[1:])
    else:
        at = np.flatnonzero(ids >= 0)
    group, (*begin, nexts), counts = _counted([ids[at + k] for k in range(prefix + 1)])
    if not prefix:  # one stripe a language, and its parts
        group = words.lang[nexts]
    key = group * PARTS + _parts(begin, nexts, hashes, hot) if group.max(initial=0) < 2**52 else None
    if key is None:  # numbers of prefixes made small
        group = np.cumsum(np.diff(group, prepend=group[:1]) != 0)
        key = group * PARTS + _parts(begin, nexts, hashes, hot)
    if (np.diff(key) < 0).any():
        order = np.argsort(key, kind="stable")
        key, nexts, counts, begin = key[order], nexts[order], counts[order], [w[order] for w in begin]
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    texts = words.texts
    begins = [texts.take(pa.array(w[heads])) for w in begin]
    joined = begins[0] if prefix == 1 else pc.binary_join_element_wise(*begins, " ") if prefix else pa.array([""] * len(heads), pa.string())
    after, often = texts.take(pa.array(nexts)), pa.array(counts > 1)
    counted = pc.binary_join_element_wise(after, pa.array(counts).cast(pa.string()), "\t")
    stripe = pa.ListArray.from_arrays(pa.array(np.append(heads, len(key)), pa.int32()), pc.if_else(often, counted, after))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(words.langs, pa.string()).take(pa.array(words.lang[nexts[heads]])), joined, pa.array(key[heads] % PARTS, pa.int32()),
            pc.binary_join(stripe, " "),
        ],
        names=["lang", "prefix", "part", "nexts"],
    )


def stripes(texts: DataFrame, prefix: int, known: PhraseFilter | None, hot: dict[int, int]) -> DataFrame:
    """Entries (``lang``, ``prefix``, ``next``, ``f``) of the merged stripes of ``texts`` (language, normalised text)."""
    sent = texts.sparkSession.sparkContext.broadcast((known, hot))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, ids in blocks(batches, prefix):
            out = stripes_of(words, ids, prefix, *sent.value)
            for a in range(0, out.num_rows, 1 << 15):
                yield out.slice(a, 1 << 15)
        release_memory()

    met = texts.mapInArrow(work, STRIPES).repartition("lang", "prefix", "part")
    entries = met.select("lang", "prefix", "part", F.explode(F.split("nexts", " ", -1)).alias("e"))
    tab = F.locate("\t", F.col("e"))
    count = F.when(tab == 0, 1).otherwise(F.expr("substring(e, locate('\t', e) + 1)").cast("long"))
    entries = entries.select("lang", "prefix", "part", F.substring_index("e", "\t", 1).alias("next"), count.alias("n"))
    return entries.groupBy("lang", "prefix", "part", "next").agg(F.sum("n").alias("f")).drop("part")


def _hot(counts: DataFrame, total: int) -> dict[int, int]:
    """Parts by hash of the prefixes with more than 1 / ``PARTS`` of all words: no more than ``PARTS`` of each length."""
    rows = counts.where(F.col("f") * F.lit(PARTS).cast("decimal(10,0)") > total).collect()
    out = {}
    for r in rows:
        words = np.array(r.phrase.split(" "), object)
        flat = word_hashes(np.full(len(words), r.lang, object), words)
        out[int(phrase_hashes(flat, len(flat))[0])] = -(-r.f * PARTS // total)
    return out


def _normalised(lang_col: str, text_col: str) -> list[Column]:
    """Language, and text with A-Z in lower case, every break a line feed and every tab a space."""
    text = F.translate(text_or_empty(text_col), A_TO_Z + BREAKS + "\t", A_TO_Z.lower() + "\n" * len(BREAKS) + " ")
    return [F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text.alias("text")]


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP, max_words: int = MAX_WORDS,
    held: int = HELD, max_filter_bits: int = MAX_FILTER_BITS,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language, by how much oftener than apart their parts stand together.

    Returns ``lang``, ``rank``, ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of the parts of its weakest cut), ``n``
    (words of the language) and ``score`` (2,000,000 a / (l + r), rounded down).  Phrases lie within pieces between punctuation
    and line breaks, and are counted wherever they begin; those of fewer than ``min_count`` occurrences are none, and those
    that a longer phrase holds in ``held`` hundredths of their occurrences or more are left out.

    Defined results: a null language is ``und``; a null or empty text has no words; documents that repeat count again; equal
    scores rank by ``a``, then by the bytes of the phrase; a language without such phrases has no rows, nor has an empty table;
    other columns, whatever their names, are not read.
    """
    texts = docs.select(*_normalised(lang_col, text_col))
    all_words = stage_table(stripes(texts, 0, None, {}), "stripes-0")
    n = all_words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = int(all_words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0])
    often = [all_words.where(F.col("f") >= min_count).select("lang", F.col("next").alias("phrase"), "f")]
    for size in range(1, max_words):
        known, hot = phrase_filter(often[-1], size, max_filter_bits), _hot(often[-1], total)
        merged = stripes(texts, size, known, hot).where(F.col("f") >= min_count)
        phrases = stage_table(merged.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "prefix", "f"), f"stripes-{size}")
        often.append(phrases)
    counts = reduce(DataFrame.unionByName, [p.select("lang", "phrase", "f") for p in often])
    found = reduce(DataFrame.unionByName, [p.select("lang", "phrase", F.col("f").alias("a")) for p in often[1:]])
    # a phrase lies in a much longer one no oftener than in one of the phrases between, which are longer by one word
    inside = [p.select("lang", F.explode(F.array(F.col("prefix"), F.expr("substring(phrase, locate(' ', phrase) + 1)"))).alias("phrase"), "f") for p in often[2:]]
    if inside:
        most = reduce(DataFrame.unionByName, inside).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        gone = F.coalesce(100 * F.col("most").cast("decimal(20,0)") >= held * F.col("a").cast("decimal(20,0)"), F.lit(False))
        found = found.join(most, ["lang", "phrase"], "left").where(~gone).drop("most")
    cut = found.withColumn("words", F.split("phrase", " ", -1))
    cut = cut.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side]).drop(side)
    score = F.expr("cast(2000000 * cast(a AS decimal(20,0)) div (l + r) AS long)")
    weakest = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    rows = weakest.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    falling = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    for by in (["lang", salt], ["lang"]):  # a hot language is ranked in shares, then what is left of them
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*falling)).cast("long")).where(F.col("rank") <= top)
    return rows.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_stripe_collocations(spark, sf_dir):
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
places AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(m)),
g AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, m, f FROM g WHERE m > 1),
inner_places AS (SELECT lang, ws, f, s, unnest(range(1, m - s + 2)) AS i FROM c, (VALUES (2), (3)) AS t(s) WHERE s < m),
held AS (SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(f) AS most FROM inner_places GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * c.f // (l.f + r.f) AS score
  FROM c, (VALUES (1), (2), (3)) AS t(k), g AS l, g AS r
  WHERE k < c.m AND l.lang = c.lang AND l.phrase = array_to_string(ws[1:k], ' ') AND r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE o = 1 AND coalesce(CAST(100 AS HUGEINT) * h.most < CAST(80 AS HUGEINT) * a, TRUE))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
