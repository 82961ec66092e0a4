"""Dictionary word repair with a moving window (M1-M7).

Broken text such as ``ham burg a ltona`` is repaired to ``hamburg altona``:
from every token, the tokens that follow are glued together (up to
``window_size`` of them) and the longest glued word found in the word list
wins; a left-to-right walk then keeps non-overlapping words.

Plan:

1. documents are hash-partitioned on their key once; later aggregates and
   windows are keyed on (document, ...) and keep that partitioning;
2. tokens with ``. _ -`` are decided once for every distinct token (merged
   form and parts looked up by a join with the word list); a document takes
   the verdicts of its own distinct tokens with it, each with a flag that says
   whether it is a compound;
3. texts are split, patched and searched for glued words on Arrow batches, by
   array arithmetic (``functions/spans.py``); a bitmap of the word list (one
   megabyte, whatever its length) holds back nearly all that are not listed;
4. what is left is joined with the word list (a broadcast below the session's
   size threshold, otherwise a shuffle join); the longest listed word per
   start is kept;
5. the walk is one pass over the matched starts, which lie sorted by document
   and position; the ends of the kept words go back to their document, where
   the wrong words are found by the same arithmetic.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import BITS, Rules, list_udf, starts_udf, sums_udf, tokens_udf, walk_udf, words_udf, wrong_udf
from ..functions.text import is_email_token, is_url_token, words
from ..schema import COMPOUND_CHARS, WORD_STRIP, Settings
from ..session import ship

#: What a compound adds to a glued word: characters no listed word holds, as
#: many as the reference engine's mark has, so the length rule counts alike.
COMPOUND_GLUE = "\0" * 9


@dataclass
class Repair:
    """Frames produced by one repair run (all lazy)."""
    tokens: DataFrame        # (key, pos, token, skip)          after M2
    best: DataFrame          # (key, pos, end, word)            M4 (+ compounds)
    kept: DataFrame          # (key, pos, end, word)            M5 spans
    text: DataFrame          # (key, text_clear)                M5
    wrong: DataFrame         # (key, pos, word)                 M6


def word_valid(tokens: DataFrame, dictionary: DataFrame, settings: Settings,
               col: str = "word") -> DataFrame:
    """M1: every row with a ``valid`` flag (empty words are never valid).

    The engine broadcasts the list while its size is below the session's
    threshold, and shuffles it beyond that (AQE splits a skewed word)."""
    d = dictionary.select(F.col("word").alias("_w"), F.lit(True).alias("_v")).distinct()
    j = tokens.join(d, F.lower(F.col(col)) == F.col("_w"), "left")
    return j.withColumn("valid", F.coalesce(F.col("_v"), F.lit(False)) & (F.length(col) > 0)) \
            .drop("_w", "_v")


def _is_compound_candidate(w: Column) -> Column:
    has = F.lit(False)
    for ch in COMPOUND_CHARS:
        has = has | F.instr(w, ch).cast("boolean")
    return has & ~is_email_token(w) & ~is_url_token(w)


#: A run of non-spaces that holds one of the compound characters, found from
#: its first character only (one look at every character).
_COMPOUND_RUN = f"(?<![^ ])[^ {re.escape(COMPOUND_CHARS)}]*+[{re.escape(COMPOUND_CHARS)}][^ ]*"


def compound_verdicts(types: DataFrame, dictionary: DataFrame, settings: Settings) -> DataFrame:
    """M2's rule for every distinct token ``w`` with ``. _ -`` inside: what it
    ``becomes``, an array of ``t`` (token) and ``c`` (compound?)."""
    t = types.select("w", F.translate("w", COMPOUND_CHARS, "").alias("merged"), words(F.col("w"), COMPOUND_CHARS).alias("parts"))
    # Every word to look up: the merged form (idx -1) and each part.
    look = t.select("w", F.explode(F.array_insert(
        F.transform("parts", lambda p, i: F.struct(i.alias("idx"), p.alias("word"))),
        1, F.struct(F.lit(-1).alias("idx"), F.col("merged").alias("word")))).alias("l")).select("w", "l.idx", "l.word")
    verdict = word_valid(look, dictionary, settings, "word").groupBy("w").agg(
        F.max(F.when(F.col("idx") == -1, F.col("valid"))).alias("merged_ok"),
        F.coalesce(F.min(F.when(F.col("idx") >= 0, F.col("valid") & (F.length("word") > 1))),
                   F.lit(True)).alias("parts_ok"))
    plain = lambda x: F.struct(x.alias("t"), F.lit(False).alias("c"))
    return t.join(verdict, "w").select("w", F.when(
        F.col("merged_ok") | (F.size("parts") == 0), F.array(plain(F.col("merged"))))
        .when(F.col("parts_ok"), F.array(F.struct(F.col("w").alias("t"), F.lit(True).alias("c"))))
        .otherwise(F.transform("parts", plain)).alias("becomes"))


def prepared(docs: DataFrame, key: str, text: str, dictionary: DataFrame, settings: Settings) -> DataFrame:
    """M2: every document with the tokens in it that the compound rule
    changes, ``own``, and what each ``becomes``.

    Tokens are split on single spaces; e-mails and URLs stay as they are.
    A token containing ``. _ -``: its merged form if that is a word; else,
    when every part is a word longer than one letter, the token as a
    compound; else its parts.  The rule is decided once for every distinct
    token; a document meets the verdicts of its own distinct tokens.
    """
    runs = F.transform(F.regexp_extract_all(text, F.lit(_COMPOUND_RUN), 0), lambda w: F.btrim(w, F.lit(WORD_STRIP)))
    own = docs.select(key, F.explode(F.array_distinct(F.filter(runs, _is_compound_candidate))).alias("w"))
    found = own.join(compound_verdicts(own.select("w").distinct(), dictionary, settings), "w")
    patches = found.groupBy(key).agg(F.collect_list(F.struct("w", "becomes")).alias("p"))
    return docs.select(key, F.col(text).alias("text")).join(patches, key, "left").select(
        key, "text", F.col("p.w").alias("own"), F.col("p.becomes").alias("becomes"))


def preprocess_tokens(docs: DataFrame, key: str, text: str, dictionary: DataFrame, settings: Settings) -> DataFrame:
    """M2 as rows: ``(key, pos, token, compound)``."""
    pre = prepared(docs, key, text, dictionary, settings)
    ship(docs.sparkSession)
    return pre.mapInArrow(tokens_udf(WORD_STRIP, [key, "pos", "token", "compound"]),
                          f"`{key}` {pre.schema[key].dataType.simpleString()}, pos int, token string, compound boolean")


def _rules(s: Settings, dictionary: DataFrame | None = None) -> Rules:
    """The window rules; with a word list also its lengths and bitmap.  At
    most 2^23 pairs of small numbers reach the driver, for any list."""
    rules = Rules(s.window_size, s.word_min_length, s.word_max_length, s.ignore_upper_case)
    if dictionary is not None:
        got = dictionary.select(F.lower("word").alias("word")).where("word is not null").mapInArrow(list_udf, "len int, bit int")
        # One row per bitmap position, its lengths as the bits of a number
        # (a glued word is shorter than the length limit).
        most = min(s.word_max_length, 62)
        per = got.groupBy("bit").agg(F.bit_or(F.expr(f"shiftleft(1L, least(len, {most}))")).alias("lens")).toArrow()
        rules.bitmap = np.zeros(1 << BITS, dtype=bool)
        rules.bitmap[per["bit"].to_numpy()] = True
        lens = int(np.bitwise_or.reduce(per["lens"].to_numpy(), initial=0))
        rules.lengths = np.array([bool(lens >> i & 1) for i in range(most)] + [True])
    return rules


def _glued(pre: DataFrame, key: str, s: Settings, dictionary: DataFrame | None = None) -> DataFrame:
    """(key, pos, j, word, compound): glued words, and the compounds."""
    ship(pre.sparkSession)
    names = [key, "pos", "j", "word", "compound"]
    return pre.mapInArrow(
        words_udf(WORD_STRIP, COMPOUND_GLUE, _rules(s, dictionary), names),
        f"`{key}` {pre.schema[key].dataType.simpleString()}, pos int, j int, word string, compound boolean")


def candidates(pre: DataFrame, key: str, s: Settings, mark: str | None = None) -> DataFrame:
    """M3 as rows: (key, pos, j, word) for every start that is not a compound.

    With ``mark``, which then stands for a compound's glue, what these rows
    come to by document and offset: (key, j, n, chars, first_word, last_word,
    checksum).  The rows are added up by the task that makes them (glued words
    are many times the text); a key that has several rows has several sums."""
    if mark is None:
        return _glued(pre, key, s).where("not compound").drop("compound")
    ship(pre.sparkSession)
    names = [key, "j", "n", "chars", "first_word", "last_word", "checksum"]
    return pre.mapInArrow(
        sums_udf(WORD_STRIP, COMPOUND_GLUE, mark, _rules(s), names), f"`{key}` {pre.schema[key].dataType.simpleString()}, "
        "j int, n long, chars long, first_word string, last_word string, checksum long")


def _hits(pre: DataFrame, key: str, dictionary: DataFrame, s: Settings) -> DataFrame:
    """M4: ``(key, pos, end, word)`` of every listed word and every compound,
    placed by document."""
    d = dictionary.select(F.col("word").alias("_w"), F.lit(True).alias("_v")).distinct()
    near = _glued(pre, key, s, dictionary)
    hit = near.join(d, F.lower("word") == F.col("_w"), "left").where("_v or compound")
    # The few hits go back to their document once; what follows stays there.
    return hit.select(key, "pos", (F.col("pos") + F.col("j") + 1).cast("int").alias("end"), "word").repartition(key)


def repair(docs: DataFrame, key: str, text: str, dictionary: DataFrame,
           settings: Settings = Settings()) -> Repair:
    """Run M2-M6 over ``docs(key, text)`` as one chain."""
    s = settings
    docs = docs.repartition(key)
    pre = prepared(docs, key, text, dictionary, s)
    ship(docs.sparkSession)
    hits = _hits(pre, key, dictionary, s)
    matched = hits.groupBy(key, "pos").agg(F.max("end").alias("end"), F.max_by("word", "end").alias("word"))
    kind = pre.schema[key].dataType.simpleString()

    # M5: one pass over a document's few hits, which lie together.
    kept = hits.sortWithinPartitions(key, "pos", F.col("end").desc()).mapInArrow(
        walk_udf([key, "pos", "end", "word"]), f"`{key}` {kind}, pos int, end int, word string")
    joined = kept.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))),
                                 lambda x: x["word"]), " ").alias("text_clear"))
    text_out = docs.select(key).join(joined, key, "left") \
                   .select(key, F.coalesce("text_clear", F.lit("")).alias("text_clear"))

    # M6: a start is wrong if the walk visits it, nothing matched there and no
    # skip rule fired.  The walk visits exactly the starts no kept word
    # reaches past; a document takes the ends of its kept words with it, and
    # only wrong starts become rows.
    starts = pre.mapInArrow(
        starts_udf(WORD_STRIP, COMPOUND_GLUE, _rules(s), [key, "pos", "token", "compound", "skip"]),
        f"`{key}` {kind}, pos int, token string, compound boolean, skip boolean")
    marks = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "end"))).alias("_k")).select(
        key, F.col("_k.pos").alias("at"), F.col("_k.end").alias("to"))
    wrong = pre.join(marks, key, "left").select(key, "text", "own", "becomes", "at", "to").mapInArrow(
        wrong_udf(WORD_STRIP, COMPOUND_GLUE, _rules(s), [key, "pos", "word"]), f"`{key}` {kind}, pos int, word string")
    return Repair(starts.select(key, "pos", "token", "skip"), matched, kept, text_out, wrong)


def clear_text(docs: DataFrame, key: str, text: str, dictionary: DataFrame,
               settings: Settings = Settings()) -> DataFrame:
    """M5: ``(key, text_clear)`` for every document."""
    return repair(docs, key, text, dictionary, settings).text


def clean_batch(ft: DataFrame, dictionary: DataFrame, mode: str = "all",
                settings: Settings = Settings()) -> DataFrame:
    """M7: recompute text_clear for the rows chosen by ``mode``: 'all',
    'empty' (text_clear still NULL) or one resource id.  Rows not chosen
    keep their text_clear; the result is the whole table."""
    if mode == "all":
        chosen = ft
    elif mode == "empty":
        chosen = ft.filter(F.col("text_clear").isNull())
    else:
        chosen = ft.filter(F.col("resource_id") == mode)
    cleaned = clear_text(chosen.select("id", "text").filter(F.col("text").isNotNull()),
                         "id", "text", dictionary, settings)
    out = ft.join(cleaned.withColumnRenamed("text_clear", "_new"), "id", "left")
    return out.select("id", "resource_id", "package_id", "text",
                      F.coalesce("_new", "text_clear").alias("text_clear"))
