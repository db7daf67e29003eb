"""Line dedup within one word of edit distance, by deletion neighbourhoods.

Two lines of words are within one insertion, deletion or replacement of a word exactly
if they share a variant: a replacement leaves the same words when that word is deleted
from both, and an insertion leaves the shorter line when it is deleted from the longer.
So every variant of a line is emitted as a hashed key, equal keys meet, and the
earliest line under each key is handed back to the others. No pairs are made, however
many lines share a key. The edit distance to that earliest line is then verified.

Only lines that can have a partner emit variants. Equal lines are one line first. One
edit leaves the first or the last half of a line untouched, so a line whose halves
occur in no other line has no partner. Halves are compared by hash before any text
moves; a bitmap of fixed size then lets the tasks pick out the texts of nearly only those
lines, and a join makes that exact.

Whole texts are shuffled once, to the numbers of the lines they lose.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracemill.llm.batches import map_slices
from tracemill.llm.shingles import finish_hash
from tracemill.sources.staging import release, stage

# Words of lines that are compared for one edit, and of those that lose exact copies.
LEAST_WORDS = 5
LEAST_EXACT = 1
# Bits of the bitmap of shared halves: eight for each of them, within these bounds. Beyond
# 2^25 shared halves the bitmap, then 32 MB, gets fuller: it prunes less, and results stay.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
BITS_PER_HALF = 8
# Spark's bits in a bucket of a bitmap.
_BUCKET = 8 * 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)


def line_words(text: str) -> list[list[bytes]]:
    """The words of every line; words lie between ASCII white space."""
    return [line.split() for line in text.encode("utf-8", "surrogatepass").split(b"\n")]


def line_digest(words: list[bytes]) -> bytes:
    return xxhash.xxh128_digest(b" ".join(words))


def half_size(shorter: int) -> int:
    """Words of a half that one edit of lines of this length leaves untouched.

    Rounded down for longer lines, so that most lengths share it with the next.
    """
    half = shorter // 2
    return half if half < 8 else half // 4 * 4


def half_keys(words: list[bytes]) -> list[int]:
    """Signed hashes of the halves that an equally long, longer or shorter line shares."""
    keys = []
    for size in {half_size(len(words)), half_size(len(words) - 1)}:
        keys.append(xxhash.xxh64_intdigest(b" ".join(words[:size]), 2 * size))
        keys.append(xxhash.xxh64_intdigest(b" ".join(words[-size:]), 2 * size + 1))
    return [key - (1 << 64) if key >> 63 else key for key in keys]


def variant_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and roles of all variants of a line.

    Lines that meet under a key of role 0 have the same length and differ at one place
    at most. Under other keys a line with a word deleted (role 1) meets the whole line
    that it is then equal to (role 2).
    """
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    n = len(hashes)
    powers = np.ones(n + 1, dtype=np.uint64)
    np.multiply.accumulate(np.full(n, _BASE), out=powers[1:])
    # What lies behind a deleted word keeps its powers, what lies before it loses one.
    terms = hashes * powers[:n][::-1]
    total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(terms)))
    behind = total[n] - total
    ahead = np.zeros(n, dtype=np.uint64)
    ahead[1:] = np.add.accumulate(hashes[:-1] * powers[: n - 1][::-1])
    without = ahead + behind[1:]
    place = finish_hash(np.arange(n, dtype=np.uint64) + np.uint64(n << 32))
    keys = np.concatenate((finish_hash(without ^ place), finish_hash(without), finish_hash(total[n:])))
    roles = np.repeat(np.array([0, 1, 2], dtype=np.int32), [n, n, 1])
    return keys.view(np.int64), roles


def within_one(one: list[str], other: list[str]) -> bool:
    """Whether one inserted, deleted or replaced word turns one line into the other."""
    if abs(len(one) - len(other)) > 1:
        return False
    start = 0
    while start < min(len(one), len(other)) and one[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(one), len(other)) - start and one[-1 - end] == other[-1 - end]:
        end += 1
    return max(len(one), len(other)) - start - end <= 1


def _identified(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column), F.xxhash64(F.col(text)), F.col(text))


def line_table(docs: DataFrame, text: str, id_column: str, least_words: int, least_exact: int) -> DataFrame:
    """``doc, text_hash, line, digest, halves`` of every line with enough words, stored.

    Lines of ``least_exact`` words are there; those under ``least_words`` have no halves.
    """

    def make():
        def step(names, hashes, texts):
            rows = []
            for name, own, whole in zip(names, hashes, texts):
                for number, words in enumerate(line_words(whole or "")):
                    if len(words) >= least_exact:
                        halves = half_keys(words) if len(words) >= least_words else []
                        rows.append((name, own, number, line_digest(words), halves))
            return [list(column) for column in zip(*rows)] or [[] for _ in range(5)]

        return step

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc {kind}, text_hash long, line int, digest binary, halves array<long>"
    return stage(map_slices(_identified(docs, text, id_column), make, schema), "lines")


def position() -> Column:
    """Documents by id, those without one last; then by line."""
    return F.struct(F.col("doc").isNull().alias("last"), "doc", "text_hash", "line")


def shared_halves(lines: DataFrame) -> DataFrame:
    """``half`` of at least two different lines, stored."""
    mark = F.xxhash64("digest").alias("mark")
    marked = lines.select(mark, F.explode("halves").alias("half"))
    ends = marked.groupBy("half").agg(F.min("mark").alias("low"), F.max("mark").alias("high"))
    return stage(ends.filter("low < high").select("half"), "shared-halves")


def bitmap_bits(halves: int) -> int:
    """The next power of two that gives every shared half its bits."""
    wanted = 1 << max(0, BITS_PER_HALF * halves - 1).bit_length()
    return min(max(wanted, LEAST_BITS), MOST_BITS)


def half_bitmap(shared: DataFrame) -> np.ndarray:
    """Bits for the shared halves, on the driver: ``MOST_BITS`` at most, whatever the data."""
    bits = bitmap_bits(shared.count())
    at = F.pmod("half", F.lit(bits))
    pieces = shared.groupBy(F.bitmap_bucket_number(at + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits")
    )
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in pieces.collect():
        start = (row.bucket - 1) * _BUCKET // 8
        bitmap[start : start + _BUCKET // 8] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def candidate_lines(docs: DataFrame, text: str, id_column: str, least_words: int, shared: DataFrame) -> DataFrame:
    """``digest, words`` of the lines that share a half with a different one, stored."""
    bitmap = docs.sparkSession.sparkContext.broadcast(half_bitmap(shared))

    def make():
        bits = bitmap.value
        size = 8 * len(bits)

        def step(names, hashes, texts):
            rows = []
            for whole in texts:
                for words in line_words(whole or ""):
                    if len(words) < least_words:
                        continue
                    halves = half_keys(words)
                    if any(bits[(h % size) >> 3] >> (h % size & 7) & 1 for h in halves):
                        line = b" ".join(words).decode("utf-8", "replace")
                        rows.append((line_digest(words), line, halves))
            return [list(column) for column in zip(*rows)] or [[], [], []]

        return step

    found = map_slices(
        _identified(docs, text, id_column), make, "digest binary, words string, halves array<long>"
    )
    found = stage(found.dropDuplicates(["digest"]), "likely-lines")
    halves = found.select("digest", F.explode("halves").alias("half"))
    sure = halves.join(shared, "half", "left_semi").select("digest").distinct()
    sought = stage(found.select("digest", "words").join(sure, "digest", "left_semi"), "candidate-lines")
    release(found)
    return sought


def earlier_near(candidates: DataFrame, firsts: DataFrame) -> DataFrame:
    """``digest`` of lines with an earlier line one edit away."""

    def make():
        def step(digests, bodies):
            out = ([], [], [])
            for digest, body in zip(digests, bodies):
                keys, roles = variant_keys(body.encode().split(b" "))
                out[0].extend([digest] * len(keys))
                out[1].extend(keys.tolist())
                out[2].extend(roles.tolist())
            return list(out)

        return step

    located = candidates.select("digest").join(firsts.select("digest", "first"), "digest")
    variants = map_slices(candidates.select("digest", "words"), make, "digest binary, key long, role int")
    variants = stage(variants, "variants")
    met = variants.groupBy("key").agg(
        *(F.count_if(F.col("role") == r).alias(f"n{r}") for r in (0, 1, 2))
    ).filter("n0 > 1 or (n1 > 0 and n2 > 0)").select("key")
    meeting = stage(variants.join(met, "key", "left_semi").join(located, "digest"), "meeting-variants")
    row = F.struct("first", "digest")
    earliest = meeting.groupBy("key").agg(
        *(F.min(F.when(F.col("role") == r, row)).alias(f"e{r}") for r in (0, 1, 2))
    )
    role = F.col("role")
    other = F.when(role == 0, F.col("e0")).when(role == 1, F.col("e2")).otherwise(F.col("e1"))
    pairs = meeting.join(earliest, "key").select("digest", "first", other.alias("other"))
    pairs = pairs.filter(F.col("other.first") < F.col("first"))
    pairs = pairs.select("digest", F.col("other.digest").alias("other")).distinct()
    left = candidates.select("digest", "words")
    right = candidates.select(F.col("digest").alias("other"), F.col("words").alias("other_words"))
    worded = pairs.join(left, "digest").join(right, "other").select("digest", "words", "other_words")

    def verify():
        def step(digests, ones, others):
            return [[d for d, a, b in zip(digests, ones, others) if within_one(a.split(" "), b.split(" "))]]

        return step

    near = stage(map_slices(worded, verify, "digest binary").distinct(), "near-lines")
    release(variants)
    release(meeting)
    return near


def lost_lines(
    docs: DataFrame, text: str, id_column: str, least_words: int = LEAST_WORDS, least_exact: int = LEAST_EXACT
) -> DataFrame:
    """``doc, text_hash, exact, near``: the numbers of the lines each document loses."""
    if least_words < 3:
        raise ValueError(f"lines of {least_words} words have no two halves")
    if not 1 <= least_exact <= least_words:
        raise ValueError(f"exact copies of {least_exact} words, near ones of {least_words}")
    lines = line_table(docs, text, id_column, least_words, least_exact)
    firsts = lines.groupBy("digest").agg(F.min(position()).alias("first"), F.count("*").alias("times"))
    firsts = stage(firsts, "first-lines")
    shared = shared_halves(lines)
    candidates = candidate_lines(docs, text, id_column, least_words, shared)
    near = earlier_near(candidates, firsts)
    release(candidates)
    release(shared)
    known = firsts.join(near.withColumn("near", F.lit(True)), "digest", "left")
    known = known.filter((F.col("times") > 1) | F.col("near")).select("digest", "first", "near")
    met = lines.select("doc", "text_hash", "line", "digest").join(known, "digest")
    exact = position() > F.col("first")
    lost = met.filter(exact | F.col("near")).select("doc", "text_hash", "line", exact.alias("exact"))
    lost = lost.distinct()
    return lost.groupBy("doc", "text_hash").agg(
        F.collect_list(F.when(F.col("exact"), F.col("line"))).alias("exact"),
        F.collect_list(F.when(~F.col("exact"), F.col("line"))).alias("near"),
    )


def _cleaned(docs: DataFrame, text: str, id_column: str, least_words: int, least_exact: int) -> DataFrame:
    """``document`` as it was, its new ``text``, and ``n_lines, n_exact, n_near``."""
    lost = lost_lines(docs, text, id_column, least_words, least_exact)
    whole = docs.select(F.struct(*docs.columns).alias("document"))
    body = F.col("document")[text]
    own = whole.select("document", F.xxhash64(body).alias("own_hash"))
    same = (own.own_hash == lost.text_hash) & own["document"][id_column].eqNullSafe(lost.doc)
    joined = own.join(lost, same, "left").select(
        "document", "exact", "near", F.concat("exact", "near").alias("gone"), F.split(body, "\n", -1).alias("lines")
    )
    # A difference of sets of numbers, which takes time in proportion to the lines.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    cleaned = F.array_join(F.transform(left, lambda at: F.get("lines", at)), "\n")
    count = lambda name: F.coalesce(F.when(F.col(name).isNotNull(), F.size(name)), F.lit(0)).cast("long").alias(f"n_{name}")
    return joined.select(
        "document",
        F.when(F.col("gone").isNull(), body).otherwise(cleaned).alias("text"),
        *(count(name) for name in ("lines", "exact", "near")),
    )


def line_report(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    least_words: int = LEAST_WORDS,
    least_exact: int = LEAST_EXACT,
) -> DataFrame:
    """Every document's ``n_lines, n_exact, n_near`` and the text that is left.

    A line goes where an earlier line, in any document, has the same words (exact) or is
    one word's insertion, deletion or replacement away (near), whether or not that one
    stays. Earlier means a smaller id, then a smaller line number; rows without id come
    last. Lines with fewer than ``least_words`` words have no near ones, and with fewer than
    ``least_exact`` they always stay; by default only lines without a word do. A null text stays null
    and has no lines, an empty one has one. Repeated rows are one document and
    lose the same lines. Other columns are not looked at.
    """
    cleaned = _cleaned(docs.select(id_column, text), text, id_column, least_words, least_exact)
    return cleaned.select(f"document.{id_column}", "n_lines", "n_exact", "n_near", F.col("text").alias(text))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    least_words: int = LEAST_WORDS,
    least_exact: int = LEAST_EXACT,
) -> DataFrame:
    """``docs`` with repeated lines cut out, by the rule of :func:`line_report`.

    Documents that lose lines and have no word left go. All columns but the text are
    handed on as they are.
    """
    cleaned = _cleaned(docs, text, id_column, least_words, least_exact)
    bare = F.regexp_like("text", F.lit(r"^[\x20\x09-\x0D]*$"))
    left = cleaned.filter((F.col("n_exact") + F.col("n_near") == 0) | ~bare)
    own = [
        F.col("text").alias(name) if name == text else F.col("document")[name].alias(name)
        for name in docs.columns
    ]
    return left.select(*own)
