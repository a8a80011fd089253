"""Many phrases in one pass over each text: automata over tables of phrases.

An Aho-Corasick automaton finds all phrases of a table in one walk over a text, however many there are.  A table is cut by
hash into parts of at most some ``PART_CHARS`` signs, so that an automaton's size is bounded; a part is one broadcast, and
one pass in tasks of its own.  Texts are read where they lie and never shuffle: a pass returns which phrases it found.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_CHARS = 1 << 20
_A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_open: dict[str, ahocorasick.Automaton] = {}


def _automaton(number: str, phrases: dict[str, object]) -> ahocorasick.Automaton:
    """The automaton of a broadcast; a Python worker keeps one."""
    if number not in _open:
        _open.clear()
        found = ahocorasick.Automaton()
        for phrase, value in phrases.items():
            found.add_word(phrase, (len(phrase), value))
        found.make_automaton()
        _open[number] = found
    return _open[number]


def plain(text: str) -> str:
    """A-Z in lower case, one space for each run of white space, none at the ends."""
    return " ".join(text.translate(_A_TO_Z).split())


def _is_word(sign: str) -> bool:
    return sign.isalnum() or sign == "_"


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether a word begins or ends at both ends of a part of the text."""
    edge = lambda k: (k > 0 and _is_word(text[k - 1])) != (k < len(text) and _is_word(text[k]))
    return edge(start) and edge(end)


def parts(phrases: DataFrame, phrase: str, part_chars: int = PART_CHARS) -> Iterator[DataFrame]:
    """``phrases`` by hash of their text in parts of bounded size."""
    chars = phrases.agg(F.coalesce(F.sum(F.length(phrase)), F.lit(0))).first()[0]
    count = max(1, -(-chars // part_chars))
    for k in range(count):
        yield phrases if count == 1 else phrases.where(F.pmod(F.xxhash64(phrase), F.lit(count)) == k)


def _first_places(docs: DataFrame, texts: list[str], most: int) -> DataFrame:
    """(``phrase``, ``doc_id``): for each phrase the least documents of each task that contain it."""
    sent, number = docs.sparkSession.sparkContext.broadcast({t: t for t in texts}), uuid.uuid4().hex
    schema = docs.select(F.lit("").alias("phrase"), "doc_id").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, least, kind = _automaton(number, sent.value), {}, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not body or not len(automaton):
                    continue
                key = (doc is not None, doc if doc is not None else 0)
                for phrase in {value for _, (_, value) in automaton.iter(body)}:
                    held = least.setdefault(phrase, [])
                    if len(held) < most or key < held[-1]:
                        at = bisect_left(held, key)
                        if at == len(held) or held[at] != key:
                            insort(held, key)
                            del held[most:]
        pairs = [(phrase, doc if there else None) for phrase, held in least.items() for there, doc in held]
        for a in range(0, len(pairs), 1 << 15):
            found, ids = zip(*pairs[a : a + (1 << 15)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(ids, kind)], names=["phrase", "doc_id"])

    return docs.select("doc_id", "body").mapInArrow(work, schema)


def containing(docs: DataFrame, phrases: DataFrame, most: int, part_chars: int = PART_CHARS) -> DataFrame:
    """(``phrase``, ``doc_id``): the first ``most`` documents, by id, that contain each phrase.

    ``docs`` has ``doc_id`` and ``body``, ``phrases`` the column ``phrase``.  A task returns ``most`` documents a phrase, so
    that a phrase that all documents contain is no hot group.  Null bodies contain nothing, null and empty phrases are none,
    rows that repeat an id are one document, and a null id is before all others.
    """
    listed = phrases.select("phrase").where("phrase <> ''").distinct()
    found = [_first_places(docs, [r.phrase for r in part.collect()], most) for part in parts(listed, "phrase", part_chars)]
    return reduce(DataFrame.unionByName, found)


def _named(texts: pa.Array, automaton: ahocorasick.Automaton, bounds: bool) -> list[list[dict]]:
    out = []
    for text in texts.to_pylist():
        text = plain(text or "")
        hits = automaton.iter(text) if len(automaton) else ()
        names = {pair for end, (size, pairs) in hits if not bounds or _bounded(text, end - size + 1, end + 1) for pair in pairs}
        out.append([{"ord": o, "name": n} for o, n in sorted(names)])
    return out


PAIRS = "array<struct<ord int, name string>>"
_ARROW_PAIRS = pa.list_(pa.struct([("ord", pa.int32()), ("name", pa.string())]))


def _namer(rows: DataFrame, part: DataFrame, bounds: bool):
    """Column function that finds the names of one part."""
    variants: dict[str, set[tuple[int, str]]] = {}
    for r in part.collect():
        if phrase := plain(r.variant):
            variants.setdefault(phrase, set()).add((r.ord, r["name"]))
    sent, number = rows.sparkSession.sparkContext.broadcast(variants), uuid.uuid4().hex

    @F.arrow_udf(PAIRS)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array(_named(texts, _automaton(number, sent.value), bounds), _ARROW_PAIRS)

    return found


def name_places(
    rows: DataFrame, text: str, names: DataFrame, key: str, out: str = "named", bounds: bool = True, part_chars: int = PART_CHARS,
) -> DataFrame:
    """Adds ``out``: struct of the first name, in the list's order, that the text holds (``name``), and how many it holds (``n``).

    ``names`` is a table (``ord``, ``name``, ``variant``): names in order, each with any number of variants.  A variant
    counts where it stands between word bounds (anywhere without ``bounds``), A-Z in any case, whatever the white space
    between its words.  ``key`` tells the rows apart; it is used only where the table has more than one part.

    Defined results: a null text holds nothing; null and blank variants are none; a variant of several names counts for each;
    signs other than letters, digits and the underscore are no part of a word.
    """
    listed = names.where("variant IS NOT NULL AND name IS NOT NULL").select(F.col("ord").cast("int").alias("ord"), "name", "variant").distinct()
    passes = [_namer(rows, part, bounds) for part in parts(listed, "variant", part_chars)]
    told = lambda pairs: F.struct(F.array_min(pairs)["name"].alias("name"), F.size(pairs).alias("n"))
    if len(passes) == 1:
        return rows.withColumn("__named", passes[0](text)).withColumn(out, told(F.col("__named"))).drop("__named")
    thin = [rows.select(F.col(key).alias("__key"), F.explode(p(text)).alias("pair")) for p in passes]
    pairs = reduce(DataFrame.unionByName, thin).groupBy("__key").agg(F.collect_set("pair").alias("__named"))  # no more than names
    joined = rows.join(pairs, rows[key].eqNullSafe(F.col("__key")), "left")
    return joined.withColumn(out, told(F.coalesce("__named", F.array().cast(PAIRS)))).drop("__named", "__key")
