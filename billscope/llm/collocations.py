"""Phrases whose words keep together: Misra-Gries summaries per hash partition, then exact counts of what survives.

Texts are cut into chunks of bounded size, at separators only, which no phrase crosses. A chunk's own n-grams are
counted exactly and sent, as 32-bit keys with counts, to the hash partition of their hash. There the chunks'
counts are merged as Misra-Gries summaries: beyond its capacity a summary takes the first count that has no room
off all counters. The capacity exceeds the partition's mass divided by the threshold, so what is taken off in all is
less than the threshold and every n-gram that reaches it survives, in bounded memory. Each chunk learns which of its
own n-grams survived, so nothing is broadcast, and counts those again by their words; sums by words are exact,
whatever the hashes did.

Nulls: a null text is empty and a null language is ``und``. Texts without words count nothing. Very long texts are
cut like others. Repeated rows count each time. Ties are broken by the phrase's bytes. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.frames import as_bytes, rows_of
from billscope.llm.running import running_within
from billscope.work import job_folder, materialise, new_path

THRESHOLD, LONGEST, TOP, SHARE = 10, 3, 2000, 50
CHUNK_BYTES = 8 << 20  # of text that is counted at once
PART_BYTES = 8 << 20  # of text whose n-grams make up one hash partition
SENT_KEYS = 1 << 18  # keys of a chunk that are sorted and sent at a time, about
CUT_BYTES = 1 << 20  # a longer text is cut at a separator
UNKNOWN = "und"

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
SEPARATOR = re.compile(b"[" + re.escape(SEPARATORS) + b"]")
PLAIN = bytes.maketrans(SEPARATORS + b"\t", b"." * len(SEPARATORS) + b" ")
BOUNDARY = b"."


class Words(dict):
    """Numbers of words in the order they are met; 0 is the boundary between pieces."""

    def __init__(self):
        super().__init__({BOUNDARY: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def numbered(texts: Iterable[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers, with 0 between pieces and texts, and the words by number."""
    words, found = Words(), [np.zeros(1, np.int32)]
    for text in texts:
        own = text.lower().translate(PLAIN).replace(BOUNDARY, b" . ").split()
        found += [np.fromiter(map(words.__getitem__, own), np.int32, len(own)), found[0]]
    return np.concatenate(found), list(words)


def ngrams(ids: np.ndarray, size: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the distinct n-grams, as (number of the n-gram without its last word, last word), and counts.

    Words are the n-grams of length one and their own last words.
    """
    counts = np.bincount(ids, minlength=size).astype(np.int32)
    counts[0] = 0
    first = np.arange(size, dtype=np.int32)
    yield first, first, counts
    places = np.flatnonzero(ids)
    shorter = ids[places]
    for length in range(2, longest + 1):
        ends = places + length - 1  # the last id is a boundary, before which any n-gram ends
        room = ends < len(ids)
        room[room] = ids[ends[room]] > 0
        places, shorter, last = places[room], shorter[room], ids[ends[room]]
        whole = shorter.astype(np.int64) * size + last
        found, shorter, counts = np.unique(whole, return_inverse=True, return_counts=True)
        yield (found // size).astype(np.int32), (found % size).astype(np.int32), counts.astype(np.int32)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hashed(lang: str, words: list[bytes], levels: Iterable[tuple]) -> Iterator[tuple[np.ndarray, tuple]]:
    """A 64-bit hash of each distinct n-gram and the n-grams, length by length."""
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    own = word = np.fromiter((xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    for length, level in enumerate(levels, 1):
        if length > 1:
            before, last, _ = level
            own = mixed(own[before] * np.uint64(0x9E3779B97F4A7C15) + word[last])
        yield own, level


def planes(values: np.ndarray) -> bytes:
    """Rising or small numbers byte by byte, which a shuffle compresses well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _parts(text: bytes, limit: int) -> Iterator[bytes]:
    """The text, cut at separators into parts that are longer than the limit only where a piece is."""
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(sign, at, at + limit) for sign in map(bytes, zip(SEPARATORS)))
        if end < at:
            later = SEPARATOR.search(text, at + limit)
            if not later:
                break
            end = later.start()
        yield text[at : end + 1]
        at = end + 1
    yield text[at:]


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, lang, text); a chunk is a run of rows of one task."""
    from pyspark import TaskContext

    chunk, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        chunks, langs, texts = [], [], []
        for lang, text in rows_of(batch):
            for part in _parts(text, CUT_BYTES):
                if held >= size:
                    chunk, held = chunk + 1, 0
                chunks.append(chunk)
                langs.append(lang)
                texts.append(part)
                held += len(part)
        columns = pa.array(chunks, pa.int64()), pa.array(langs, pa.string()), pa.array(texts, pa.binary())
        yield pa.RecordBatch.from_arrays(list(columns), ["chunk", "lang", "text"])


def _by_lang(table: pa.Table) -> Iterator[tuple[str, list[bytes]]]:
    langs = table["lang"].to_numpy(zero_copy_only=False)
    for lang in sorted(set(langs)):
        yield lang, as_bytes(table["text"].filter(pa.array(langs == lang)))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Chunks of a task in the order they come, each as one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch["chunk"].to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for start, end in zip(starts, starts[1:], strict=False):
            if held and start < end and held[0]["chunk"][0].as_py() != numbers[start]:
                yield held[0]["chunk"][0].as_py(), pa.Table.from_batches(held)
                held = []
            if start < end:
                held.append(batch.slice(start, end - start))
    if held:
        yield held[0]["chunk"][0].as_py(), pa.Table.from_batches(held)


def _places(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition and key in it, as one number."""
    return (hashes >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def _summaries(batches: Iterator[pa.RecordBatch], parts: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's n-grams as keys with counts, one row a hash partition, some hash partitions at a time."""
    for chunk, table in _chunks(batches):
        keys, counts = [], []
        for lang, texts in _by_lang(table):
            ids, words = numbered(texts)
            for hashes, (_, _, count) in hashed(lang, words, ngrams(ids, len(words), longest)):
                keys.append(_places(hashes[count > 0], parts))
                counts.append(count[count > 0])
            del texts, ids, words, hashes, count
        slices = min(parts, -(-sum(map(len, keys)) // SENT_KEYS))
        for number in range(slices):
            low, high = (np.uint64(parts * at // slices << 32) for at in (number, number + 1))
            some = [(own >= low) & (own < high) for own in keys]
            key, count = _summed(*(np.concatenate([own[m] for own, m in zip(x, some, strict=True)]) for x in (keys, counts)))
            if len(key):
                yield _sent(chunk, key, count)


def _sent(chunk: int, key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    """Rows (part, chunk, keys, counts) of sorted keys."""
    part = (key >> np.uint64(32)).astype(np.int64)
    starts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    rows = [(planes(key[a:b].astype(np.uint32)), planes(count[a:b])) for a, b in zip(starts, starts[1:], strict=False)]
    columns = [
        pa.array(part[starts[:-1]]),
        pa.array(np.full(len(rows), chunk)),
        pa.array([own for own, _ in rows], pa.binary()),
        pa.array([own for _, own in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "chunk", "keys", "counts"])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def merged(summaries: Iterable[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries summary of ``capacity`` counters from many, and the most that is missing from any count.

    Summaries are joined as they come; whenever there are more than twice as many counters as the capacity, the
    largest count without room is taken off all and what has no count left goes. Each count taken off one counter is
    taken off ``capacity`` others too, so no count loses more than the mass divided by the capacity plus one.
    """
    keys, counts, missing = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    held_keys, held_counts, held = [], [], 0

    def join(keys, counts, missing):
        keys, counts = _summed(np.concatenate([keys, *held_keys]), np.concatenate([counts, *held_counts]))
        if len(keys) > capacity:
            off = np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
            counts, missing = counts - off, missing + int(off)
            keys, counts = keys[counts > 0], counts[counts > 0]
        return keys, counts, missing

    for own_keys, own_counts in summaries:
        held_keys.append(own_keys)
        held_counts.append(own_counts.astype(np.int64))
        held += len(own_keys)
        if len(keys) + held > 2 * capacity:
            keys, counts, missing = join(keys, counts, missing)
            held_keys, held_counts, held = [], [], 0
    return join(keys, counts, missing)


def _survivors(table: pa.Table, threshold: int) -> pa.Table:
    """Which keys of each chunk may reach the threshold in the whole hash partition."""
    keys, counts = ([unplaned(data) for data in as_bytes(table[name])] for name in ("keys", "counts"))
    mass = sum(int(own.sum(dtype=np.int64)) for own in counts)
    found, count, missing = merged(zip(keys, counts, strict=True), mass // threshold + 1)
    frequent = found[count + missing >= threshold]
    own = [key[_among(key, frequent)] for key in keys]
    some = pa.array([len(key) > 0 for key in own])
    data = pa.array([planes(key) for key in own], pa.binary())
    return pa.table({"chunk": table["chunk"], "part": table["part"], "keys": data}).filter(some)


def _count(texts: pa.Table, verdicts: pa.Table, parts: int, longest: int) -> pa.Table:
    """Exact counts of a chunk's surviving n-grams, and under the empty phrase of its words."""
    known = [
        np.uint64(part) << np.uint64(32) | unplaned(data).astype(np.uint64)
        for part, data in zip(verdicts["part"].to_pylist(), as_bytes(verdicts["keys"]), strict=True)
    ]
    known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
    names, tables = ["lang", "length", "phrase", "n"], []

    def counted(lang: str, length: int, phrases: list[bytes], counts: np.ndarray) -> None:
        phrase = pa.array(phrases, pa.binary()).cast(pa.string())
        arrays = [pa.array([lang] * len(phrases), pa.string()), pa.array([length] * len(phrases), pa.int32()), phrase]
        tables.append(pa.table([*arrays, pa.array(counts, pa.int64())], names))

    for lang, own in _by_lang(texts):
        ids, words = numbered(own)
        shown = words
        for length, (hashes, (before, last, count)) in enumerate(hashed(lang, words, ngrams(ids, len(words), longest)), 1):
            some = np.flatnonzero(count)
            some = some[_among(_places(hashes[some], parts), known)]
            if length > 1:  # a part of a surviving n-gram is as frequent, so it survived and has its text
                texts_of = dict.fromkeys(some.tolist())
                for n, b, w in zip(some.tolist(), before[some].tolist(), last[some].tolist(), strict=True):
                    head = shown[b] if length == 2 else shown.get(b)
                    texts_of[n] = head and head + b" " + words[w]
                some = np.array([n for n, text in texts_of.items() if text], np.int64)
                shown = texts_of
            counted(lang, length, [shown[n] for n in some.tolist()], count[some])
        counted(lang, 0, [b""], np.array([np.count_nonzero(ids)]))
    return pa.concat_tables(tables).combine_chunks()


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
    return known[at] == values if len(known) else np.zeros(len(values), bool)


def frequent_phrases(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    lang_col: str = "lang",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(lang, length, phrase, n) of every phrase of 1 to ``longest`` words that occurs ``threshold`` times.

    The row with the empty phrase, of length 0, has the number of all words.
    """
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "frequent-phrases")
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    with job_folder(spark, "phrases"):
        cut = docs.select(lang, text).mapInArrow(partial(_cut, size=chunk_bytes), "chunk long, lang string, text binary")
        chunks = materialise(cut, "chunks")
        size = chunks.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        parts = max(1, -(-size // part_bytes))
        sent = chunks.mapInArrow(
            partial(_summaries, parts=parts, longest=longest), "part long, chunk long, keys binary, counts binary"
        )
        verdicts = sent.groupBy("part").applyInArrow(
            lambda group: _survivors(group, threshold), "chunk long, part long, keys binary"
        )
        counted = chunks.groupBy("chunk").cogroup(verdicts.groupBy("chunk"))
        counted = counted.applyInArrow(
            lambda texts, own: _count(texts, own, parts, longest), "lang string, length int, phrase string, n long"
        )
        total = counted.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n"))
        total = total.where((F.col("n") >= threshold) | (F.col("length") == 0))
        total.write.parquet(path)
    return spark.read.schema(total.schema).parquet(path)


def _words(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a² / (l r)) in exact numbers; counts of up to 15 digits."""
    a, l, r = (count.cast("decimal(15,0)") for count in (a, l, r))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l * r)


def scored(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, score, longer) of the phrases of two words and more of ``frequent_phrases``.

    The cut with the lowest score counts, the first of equals. ``longer`` is the highest count among longer frequent
    phrases that hold this one. Parts and longer phrases meet in one aggregate; a part that is common to many phrases
    is joined, not gathered.
    """
    phrases = found.where("length > 1")
    cuts = F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut")
    ends = F.array(
        F.struct(F.lit("l").alias("side"), _words(F.lit(1), F.col("cut")).alias("part")),
        F.struct(F.lit("r").alias("side"), _words(F.col("cut") + 1, F.col("length") - F.col("cut")).alias("part")),
    )
    sides = phrases.select("lang", "length", "phrase", F.col("n").alias("a"), cuts)
    sides = sides.select("lang", "phrase", "a", "cut", F.inline(ends))
    parts = found.where(F.col("length").between(1, longest - 1))
    parts = parts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    known = sides.join(parts, ["lang", "part"]).select("lang", "phrase", "a", "cut", "side", "f")
    size = F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("size")
    first = F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("first")
    held = phrases.where("length > 2").select("lang", "length", "phrase", F.col("n").alias("longer"), size)
    held = held.select("lang", "phrase", "longer", "size", first)
    held = held.select("lang", _words(F.col("first"), F.col("size")).alias("phrase"), "longer")
    count = {
        f"{side}{cut}": F.max(F.when((F.col("cut") == cut) & (F.col("side") == side), F.col("f")))
        for cut in range(1, longest)
        for side in "lr"
    }
    whole = known.unionByName(held, allowMissingColumns=True).groupBy("lang", "phrase")
    whole = whole.agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *[c.alias(name) for name, c in count.items()])
    options = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(f"l{cut}").isNotNull(),
                    F.struct(
                        score(F.col("a"), F.col(f"l{cut}"), F.col(f"r{cut}")).alias("score"),
                        F.lit(cut).alias("cut"),
                        F.col(f"l{cut}").alias("l"),
                        F.col(f"r{cut}").alias("r"),
                    ),
                )
                for cut in range(1, longest)
            ]
        )
    )
    best = whole.select("lang", "phrase", "a", "longer", F.array_min(options).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score", "longer")


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    top: int = TOP,
    share: int = SHARE,
    lang_col: str = "lang",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Phrases within a longer frequent one with ``share`` hundredths of their count are left out. Order: by score and
    count, falling, then by the phrase's bytes.
    """
    found = frequent_phrases(docs, threshold, longest, lang_col, text_col, chunk_bytes, part_bytes)
    kept = scored(found, longest).where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    placed = running_within(kept, "lang", order, {"rank": F.lit(1).cast("long")}).where(F.col("rank") <= top)
    totals = found.where("length = 0").select("lang", F.col("n"))
    return placed.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
