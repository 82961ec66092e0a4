"""Licence scan: sparse TF-IDF cosine of texts to licence templates, and
inheritance from the nearest ancestor directory's licence file (DataFrame
only).

Terms are runs of ASCII letters and digits, lower-cased; a term's inverse
document frequency comes from all files (terms outside the templates'
vocabulary weigh as the rarest).  Files are known by a digest of their text:
files of equal texts are scanned once and get the same licence, whatever their
ids.  Compared are

* every line with the one-line notices;
* every run of as many terms as a template has, for templates of up to
  ``EVERY`` terms, and every run that begins at a multiple of an eighth of the
  template's length, for longer ones; runs of notices are those that go over a
  line's end (a wrapped notice), runs of headers, titles and full licence texts
  may lie anywhere;
* the whole text, if it has at most ``WHOLE`` times the template's terms (a
  licence file), with headers, titles and full licence texts.

One pass over the texts keeps (digest, term) for the templates' terms; document
frequencies and candidates come from that table, and only candidates' texts are
read again.  What is left out before a cosine is computed cannot reach the
threshold: a line needs one of a notice's heavy terms (the light rest has less
than ``threshold`` of the norm); a text needs one of a template's rare terms and
terms of ``threshold ** 2`` of its squared norm; a run needs such a rare term
too, so only blocks of terms in reach of one are kept; a run's dot product and
a bound of its norm from below are sums over its terms, and their quotient
bounds the cosine from above.

A file's own licence is its best line's or run's; ties go to lines, then to
the earlier line, then the smaller template.  A file without one takes the
licence of the licence file (``LICENSE``, ``COPYING``, ``NOTICE`` and the like)
in its directory or the nearest directory above; ancestors are expanded per
distinct directory.

Templates are a parameter of fixed size, so their weights are broadcast.

Defined results: null or empty texts have no own licence; a null path has no
directory and inherits nothing; null and repeated ids and repeated rows are
files of their own (a repeated row counts again in the frequencies); several
licence files in a directory are settled by score, then name; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.keys import near_keys
from .common import cut, stored

THRESHOLD = 0.7
#: Templates of units are numbered from here.
FIRST_UNIT = 1000
#: Terms of the longest template whose runs begin at every term.
EVERY = 32
#: A text is compared as a whole up to this many times a template's terms.
WHOLE = 2
#: A template's length in the fixed-point places of its runs.
ONE_LENGTH = 1 << 30
#: Terms of a text that are kept or left together.
BLOCK = 32
#: File names that license their directory (compared in upper case, up to a dot).
LICENSE_FILES = ("LICENSE", "LICENCE", "COPYING", "NOTICE", "UNLICENSE")

#: (licence, notice) pairs: the usual one-line notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} "
        "as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. "
        "You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>.")
_SPDX = ("MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
         "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0",
         "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "CC0-1.0", "CC-BY-4.0",
         "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "Unlicense")

#: (licence, text) pairs: file headers, titles of licence files, SPDX lines.
HEADERS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
    ("GPL-2.0", _GNU.format("General Public License", 2)), ("GPL-3.0", _GNU.format("General Public License", 3)),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
     "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"),
    *((x.removesuffix("-only").removesuffix("-or-later"), f"SPDX-License-Identifier: {x}") for x in _SPDX),
)


def full_texts() -> list[tuple[str, str]]:
    """(licence, text) of the full licence texts beside this file; read on the driver."""
    return [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]


def terms(text):
    """Terms of a text column, in order (an empty string may stand at an end)."""
    return F.split(F.lower(text), "[^a-z0-9]+")


def template_weights(vocabulary: DataFrame, df: DataFrame, total: int) -> DataFrame:
    """``vocabulary`` (template, license, unit, term, tf) with idf weights
    ``w``, the template's ``norm`` and ``length``, the norm ``below`` of its
    terms up to this one by weight, and ``rest``, by idf."""
    idf = F.log(F.lit(1.0 + total) / (1.0 + F.coalesce("df", F.lit(0))))
    t = vocabulary.join(df, "term", "left").withColumn("idf", idf).withColumn("w", F.col("tf") * F.col("idf"))
    every = W.partitionBy("template")
    square = F.sum(F.col("w") * F.col("w"))
    return (t.withColumn("norm", F.sqrt(square.over(every))).withColumn("length", F.sum("tf").over(every))
            .withColumn("below", F.sqrt(square.over(every.orderBy("w", "term"))))
            .withColumn("rest", F.sqrt(square.over(every.orderBy("idf", "term")))).where("norm > 0"))


def held_terms(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(key, term, copies)``: the templates' terms in every distinct text."""
    words = F.broadcast(vocabulary.select("term").distinct())
    return (texts.select("key", F.explode(F.array_distinct(terms("text"))).alias("term")).join(words, "term")
            .groupBy("key", "term").agg(F.count(F.lit(1)).alias("copies")))


def candidates(held: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """``(key, template)`` of the texts whose terms may reach a template."""
    rare = F.broadcast(weights.where(F.col("rest") >= threshold * F.col("norm")).select("term", "template"))
    some = held.join(rare, "term").select("key", "template").distinct()
    side = F.broadcast(weights.select("term", "template", "w", "norm"))
    mass = (held.join(some.select("key").distinct(), "key", "left_semi").join(side, "term")
            .groupBy("key", "template", "norm").agg(F.sum(F.col("w") * F.col("w")).alias("mass"))
            .where(F.col("mass") >= threshold ** 2 * F.col("norm") * F.col("norm") * (1 - 1e-9)))
    return mass.join(some, ["key", "template"], "left_semi").select("key", "template")


def texts_once(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``(key, text)``: each distinct text of these keys once, laid out by key.
    A bitmap of the keys leaves most other texts where they are."""
    one = near_keys(texts, keys, "key").join(keys, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return stored(one, "license_texts", "key", _parts(texts))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _placed(text):
    """All terms of a text in order, each with its line."""
    line = lambda x, i: F.transform(F.filter(terms(x), lambda t: t != ""),
                                    lambda t: F.struct(i.alias("line"), t.alias("term")))
    return F.flatten(F.transform(F.split(text, "\n"), line))


def _weighed(words: DataFrame, weights: DataFrame, total: int) -> DataFrame:
    """``words`` with ``idf``; terms outside the templates weigh as the rarest."""
    idf = F.broadcast(weights.select("term", "idf").distinct())
    return words.join(idf, "term", "left").withColumn("idf", F.coalesce("idf", F.log(F.lit(1.0 + total))))


def near_terms(one: DataFrame, chosen: DataFrame, weights: DataFrame, total: int, threshold: float) -> DataFrame:
    """``(key, pos, line, term, idf, size)`` of the blocks of terms that a run
    with a rare term of its template reaches into, and of all blocks of a text
    that is compared as a whole (``size``: its number of terms)."""
    words = one.select("key", _placed(F.col("text")).alias("ws"))
    rare = F.broadcast(weights.where(F.col("rest") >= threshold * F.col("norm")).select("term", "template", "length"))
    hits = (words.select("key", F.posexplode("ws").alias("pos", "x")).select("key", F.col("x.term").alias("term"), "pos").join(rare, "term")
            .select("key", "template", "length", F.expr(f"pos div {BLOCK}").alias("b")).distinct()
            .join(chosen, ["key", "template"], "left_semi"))
    reach = hits.select("key", F.explode(F.sequence(F.expr(f"greatest(b * {BLOCK} - length + 1, 0) div {BLOCK}"),
                                                   F.expr(f"((b + 1) * {BLOCK} + length - 2) div {BLOCK}"))).alias("b"))
    lengths = F.broadcast(weights.where("unit").select("template", "length").distinct())
    short = (words.select("key", F.size("ws").alias("size")).join(chosen, "key").join(lengths, "template")
             .where(F.col("size") <= WHOLE * F.col("length"))
             .select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"size div {BLOCK}"))).alias("b")))
    blocks = reach.unionByName(short).distinct().groupBy("key").agg(F.collect_list("b").alias("bs"))
    cut_out = lambda b: F.transform(F.slice("ws", (b * BLOCK + 1).cast("int"), F.lit(BLOCK)),
                                    lambda w, i: F.struct((b * BLOCK + i).cast("int").alias("pos"), w["line"].alias("line"),
                                                          w["term"].alias("term")))
    # Blocks are moved to their texts.
    kept = one.join(blocks, "key").select("key", "bs", _placed(F.col("text")).alias("ws")).select("key", F.size("ws").alias("size"), F.explode(F.flatten(F.transform(
        F.filter("bs", lambda b: b * BLOCK < F.size("ws")), cut_out))).alias("x"))
    return _weighed(kept.select("key", "x.pos", "x.line", "x.term", "size"), weights, total)


def _scores(x: DataFrame, weights: DataFrame, unit: list[str]) -> DataFrame:
    """Cosine of every unit (columns ``unit``, with ``template``) from its
    terms' ``x = tf * idf``."""
    side = F.broadcast(weights.select("term", "template", "license", "w", "norm"))
    info = F.broadcast(weights.select("template", "license", "norm").distinct())
    return (x.join(side.select("term", "template", "w"), ["term", "template"], "left").groupBy(*unit)
            .agg(F.sum(F.col("x") * F.col("w")).alias("dot"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("size"))
            .join(info, "template").withColumn("score", F.col("dot") / (F.col("size") * F.col("norm"))))


def scan_lines(one: DataFrame, weights: DataFrame, total: int, threshold: float) -> DataFrame:
    """Best notice of every line that reaches the threshold; terms outside
    the notices weigh as the rarest."""
    notices = weights.where("not unit")
    heavy = [r[0] for r in notices.where(F.col("below") >= threshold * F.col("norm")).select("term").distinct()
             .orderBy("term").collect()]  # of a few one-line notices
    some = F.arrays_overlap("t", F.array(*map(F.lit, heavy)).cast("array<string>"))
    lines = (one.select("key", F.posexplode(F.split("text", "\n")).alias("line", "x")).withColumn("t", terms("x")).where(some)
             .select("key", "line", F.explode("t").alias("term")).where("term != ''"))
    tf = (_weighed(lines, notices, total).groupBy("key", "line", "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("x")))
    tf = tf.withColumn("size", F.sqrt(F.sum(F.col("x") * F.col("x")).over(W.partitionBy("key", "line"))))
    side = F.broadcast(notices.select("term", "template", "license", "w", "norm"))
    dots = (tf.join(side, "term").groupBy("key", "line", "size", "template", "license", "norm")
            .agg(F.sum(F.col("x") * F.col("w")).alias("dot")))
    hit = dots.withColumn("score", F.col("dot") / (F.col("size") * F.col("norm")))
    best = F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("template")).alias("order"), "license")).alias("b")
    return (hit.where(F.col("score") >= threshold).groupBy("key", "line").agg(best)
            .select("key", "line", (-F.col("b.order")).alias("template"), "b.license", "b.score"))


def scan_runs(one: DataFrame, words: DataFrame, chosen: DataFrame, weights: DataFrame, total: int, threshold: float) -> DataFrame:
    """Runs of terms, and whole texts, that reach their template."""
    info = F.broadcast(weights.select("template", "unit", "norm", "length").distinct())
    side = F.broadcast(weights.select("term", "template", "w"))
    at = chosen.join(words.drop("line"), "key").join(side, ["term", "template"], "left")
    part, square = F.col("idf") * F.coalesce("w", F.lit(0.0)), F.col("idf") * F.col("idf")
    # Places in lengths of the template, so that one frame serves them all.
    at = at.join(info, "template").withColumn("p", F.expr(f"pos * {ONE_LENGTH}L div length"))
    every = W.partitionBy("key", "template")
    ahead = every.orderBy("p").rangeBetween(0, ONE_LENGTH - 1)
    over = lambda w: F.struct(F.sum(part).over(w).alias("dot"), F.sum(square).over(w).alias("low"), F.count(F.lit(1)).over(w).alias("n"),
                              F.max("pos").over(w).alias("end"))
    sums = at.select("key", "template", "unit", "norm", "size", "length", "pos", over(ahead).alias("run"), over(every).alias("all"))
    stride = F.when(F.col("length") <= EVERY, F.lit(1)).otherwise(F.expr("length div 8"))
    # A run without a gap has all its terms, or ends with its text.
    full = F.col("run.n") == F.least(F.col("length"), F.col("size") - F.col("pos"))
    whole = (F.col("pos") == 0) & F.col("unit") & (F.col("size") > F.col("length")) & (F.col("all.n") == F.col("size"))
    units = F.array(F.when((F.col("pos") % stride == 0) & full, F.col("run")),
                    F.when(whole & (F.col("size") <= WHOLE * F.col("length")), F.col("all")))
    may = cut(sums.select("key", "template", "unit", "norm", F.col("pos").alias("start"), F.explode(F.array_compact(units)).alias("u"))
              .where("u.dot > 0").where(F.col("u.dot") >= threshold * F.col("norm") * F.sqrt("u.low") * (1 - 1e-9))
              .select("key", "template", "unit", "start", F.col("u.end").alias("end")), "license-runs")
    # Few runs are left; their terms come from the texts, to which the runs are moved.
    runs = may.groupBy("key").agg(F.collect_list(F.struct("template", "unit", "start", "end")).alias("runs"))
    terms_of = lambda r: F.transform(F.slice("ws", r["start"] + 1, r["end"] - r["start"] + 1),
                                     lambda w: F.struct(r["template"].alias("template"), r["unit"].alias("unit"), r["start"].alias("start"),
                                                        r["end"].alias("end"), w["line"].alias("line"), w["term"].alias("term")))
    held = (one.join(runs, "key").select("key", "runs", _placed(F.col("text")).alias("ws"))
            .select("key", F.explode(F.flatten(F.transform("runs", terms_of))).alias("x")).select("key", "x.*"))
    held = _weighed(held, weights, total)
    unit = ["key", "template", "start", "end"]
    x = held.groupBy(*unit, "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("x"))
    where = held.groupBy(*unit).agg(F.min("line").alias("line"), F.max("line").alias("last"), F.first("unit").alias("unit"))
    return (_scores(x, weights, unit).where(F.col("score") >= threshold).join(where, unit).where("unit or line < last")
            .select("key", "line", "template", "license", F.round("score", 9).alias("score")))


def _directories(path):
    """All directories above a path, the nearest first ('' is the root)."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)),
                       lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD,
         units: DataFrame | None = None) -> DataFrame:
    """``fid``, ``license``, ``score``, ``origin`` ('own', 'inherited' or
    null) and ``depth`` (directories up to the licence file) for every row of
    ``files(fid, path, text)``."""
    spark = files.sparkSession
    frame = lambda rows: spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                                               "template int, license string, text string")
    if templates is None:
        templates = frame(TEMPLATES)
    if units is None:
        units = frame([*HEADERS, *full_texts()])
    both = templates.withColumn("unit", F.lit(False)).unionByName(
        units.withColumn("template", F.col("template") + FIRST_UNIT).withColumn("unit", F.lit(True)))
    vocabulary = cut(both.select("template", "license", "unit", F.explode(terms("text")).alias("term")).where("term != ''")
                     .groupBy("template", "license", "unit", "term").agg(F.count(F.lit(1)).alias("tf")), "license-vocabulary")
    keyed = files.select("fid", "path", F.md5("text").alias("key"))
    texts = files.select(F.md5("text").alias("key"), "text").where("text is not null")
    held = cut(held_terms(texts, vocabulary), "license-terms")
    total = files.count()
    df = held.groupBy("term").agg(F.sum("copies").alias("df"))
    weights = cut(template_weights(vocabulary, df, total), "license-weights")
    chosen = cut(candidates(held, weights, threshold), "license-candidates")
    heavy = F.broadcast(weights.where(~F.col("unit") & (F.col("below") >= threshold * F.col("norm"))).select("term").distinct())
    keys = chosen.select("key").union(held.join(heavy, "term").select("key")).distinct()
    one = texts_once(texts, keys)
    words = stored(near_terms(one, chosen, weights, total, threshold), "license_words", "key", _parts(files))
    found = scan_lines(one, weights, total, threshold).withColumn("is_line", F.lit(1)).unionByName(
        scan_runs(one, words, chosen, weights, total, threshold).withColumn("is_line", F.lit(0)))
    order = F.struct("score", "is_line", (-F.col("line")).alias("o"), (-F.col("template")).alias("t"), "license")
    own = cut(found.groupBy("key").agg(F.max(order).alias("b")).select("key", "b.license", "b.score"), "own-licenses")
    base = F.upper(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1))
    places = keyed.select("fid", "key", "path", F.element_at(_directories(F.col("path")), 1).alias("dir"), base.alias("base"))
    grants = (places.where(F.col("base").isin(*LICENSE_FILES)).join(own, "key")
              .groupBy("dir").agg(F.max(F.struct("score", "license")).alias("g"))
              .select(F.col("dir").alias("above"), "g.license", "g.score"))
    # Directories, not files, meet the grants: each distinct one is expanded once.
    dirs = places.where("dir is not null").select("dir").distinct()
    up = dirs.select("dir", F.posexplode(_directories(F.concat("dir", F.lit("/x")))).alias("depth", "above"))
    up = up.unionByName(dirs.where("dir = ''").select("dir", F.lit(0).alias("depth"), F.lit("").alias("above")))
    nearest = (up.distinct().join(grants, "above").groupBy("dir")
               .agg(F.min(F.struct("depth", "license", "score")).alias("n"))
               .select("dir", "n.depth", F.col("n.license").alias("from_dir"), F.col("n.score").alias("dir_score")))
    out = places.select("fid", "key", "dir").join(own, "key", "left").join(nearest, "dir", "left")
    has = F.col("license").isNotNull()
    return out.select(
        "fid", F.coalesce("license", "from_dir").alias("license"),
        F.round(F.coalesce("score", "dir_score"), 6).alias("score"),
        F.when(has, "own").when(F.col("from_dir").isNotNull(), "inherited").alias("origin"),
        F.when(has, F.lit(0)).otherwise(F.col("depth")).cast("int").alias("depth"))
