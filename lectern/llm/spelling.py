"""Spelling variants grouped by permuterm rotations.

A word is closed by a terminator and written in all its rotations. The rotation that begins behind a
character ends with that character, so what stands before it, the rotation's stem, is the word with one
character skipped. In sorted order the words that differ only in that character are one range, behind
the rotation of the word that lacks it, which is the stem itself. Such a range is brought together by its
stem, wherever the words were. A stem's group therefore holds at most
one word per character of the alphabet and one without it; scanning it gives each member its neighbours
by replacement, insertion and deletion.

Near words form a graph in which every word may point to a much more frequent one, its form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import ascii_lower
from lectern.operators.rows import sized
from lectern.session import stage

RUN = r"[A-Za-zÀ-ÿ]+"
SLIP_EVERY = 97

MIN_LENGTH, MIN_COUNT = 5, 3
# How many times as frequent a form is at least.
RATIO = 2

# Fixed value: a character that no run of letters holds.
TERMINATOR = "$"


def slipped_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = SLIP_EVERY) -> DataFrame:
    """word: one row per run of letters of the whole texts, in lower case (A-Z only).

    Where ``every`` divides the crc32 of ``<id>:<word>``, the character at that number modulo the length is
    left out, as a slip of the pen would; a run of one character then gives an empty word. Null texts have
    no runs; a null id stands as an empty text in the hash. Rows that repeat each count.
    """
    lowered = ascii_lower(F.col(text))
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"),
    )
    hashed = runs.withColumn("_h", F.crc32(F.encode(F.concat("_id", F.lit(":"), "_run"), "UTF-8")))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    shorter = F.concat(F.left("_run", at), F.substring(F.col("_run"), at + 2, F.char_length("_run")))
    return hashed.select(F.when(F.col("_h") % every == 0, shorter).otherwise(F.col("_run")).alias("word"))


def count_words(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the distinct words with so many characters and occurrences at least. Each task sums its
    own words first, so that a word in every text is one row per task."""
    long = words.where(F.char_length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """stem, word, n, whole, once: all rotations of the words with their terminator.

    ``whole`` marks the rotation as the stem itself (the word lacks the character), else the stem is the
    rotation without its last character. Skipping any of a run of equal characters gives the same shorter
    word, so only the run's last one is marked ``once`` as the place where that word is met.
    """
    length = F.char_length("word")
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("_at"))
    before, behind = F.left("word", F.col("_at")), F.substring(F.col("word"), F.col("_at") + 1, length)
    here, following = F.substring(F.col("word"), F.col("_at") + 1, F.lit(1)), F.substring(F.col("word"), F.col("_at") + 2, F.lit(1))
    skipped = F.substring(F.col("word"), F.col("_at") + 2, length)
    kinds = F.array(
        F.struct(F.concat(behind, F.lit(TERMINATOR), before).alias("stem"), F.lit(True).alias("whole"), F.lit(True).alias("once")),
        F.struct(F.concat(skipped, F.lit(TERMINATOR), before).alias("stem"), F.lit(False).alias("whole"), (here != following).alias("once")),
    )
    # at the last place there is no character to skip
    kinds = F.when(F.col("_at") < length, kinds).otherwise(F.slice(kinds, 1, 1))
    return places.select("word", "n", F.explode(kinds).alias("_r")).select("_r.stem", "word", "n", "_r.whole", "_r.once")


def _other(member: Column, other: Column) -> Column:
    """Whether two members of a stem's group are near: two with a character at its place, or the word
    without it and one that is met there once."""
    both = ~member["whole"] & ~other["whole"] & (member["word"] != other["word"])
    return both | ((member["whole"] != other["whole"]) & member["once"] & other["once"])


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best: how many words are near and the most frequent of them (``lower``, its count below
    zero, and ``near``; of equal counts the smallest word), only for words that have any.

    A near pair meets in exactly one stem. A group is bounded by the alphabet, and gives one row per
    member, not one per pair; the rows of a word are then summed.
    """
    members = rotations(words).withColumn("_m", F.struct("word", F.negate("n").alias("lower"), "whole", "once"))
    groups = members.groupBy("stem").agg(F.collect_list("_m").alias("_all")).where(F.size("_all") > 1)
    one = F.explode("_all").alias("_one")
    scanned = groups.select(one, "_all").select(
        F.col("_one.word").alias("word"), F.filter("_all", lambda other: _other(F.col("_one"), other)).alias("_near")
    )
    best = F.array_min(F.transform("_near", lambda m: F.struct(m["lower"].alias("lower"), m["word"].alias("near"))))
    met = scanned.where(F.size("_near") > 0).select("word", F.size("_near").cast("long").alias("n_near"), best.alias("best"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached from each by following forms, for words that have one.

    Every round doubles the steps: a pointer is replaced by the pointer of its target. A form is at least
    twice as frequent as its word, so a path has at most as many steps as a count has bits, and six
    rounds are enough. Every round is written.
    """
    moving = stage(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = sized(moving.select(F.col("word").alias("_from"), F.col("root").alias("_to")))
        step = stage(moving.join(ahead, F.col("root") == F.col("_from"), "left").select("word", "root", "_to"), "spelling-steps")
        moving = step.select("word", F.coalesce("_to", "root").alias("root"))
        if not step.where("_to IS NOT NULL").take(1):
            return moving


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words with their counts (word, n).

    Two words are near if one inserted, deleted or replaced character makes one of the other. A word's form
    is its near word of the largest count (of equal ones the smallest in code-point order), if that count is
    at least ``ratio`` times its own (more than once, so that forms make no circle), else null. Its root is
    where following forms ends: the word itself if it has none. ``n_near`` is 0 without near words.

    Words must be distinct and without the terminator. The empty word is near to words of one character.
    Null words are left out. An empty table gives no rows. Further columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent")
    counted = stage(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = neighbours(counted)
    best_n = F.negate(F.col("best.lower"))
    formed = best_n >= F.col("n") * ratio
    table = stage(
        counted.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, best_n).alias("form_n"),
        ),
        "spelling-near",
    )
    found = roots(table.where("form IS NOT NULL"))
    with_root = table.join(sized(found), "word", "left")
    return with_root.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
