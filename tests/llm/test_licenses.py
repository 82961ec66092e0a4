from doctext.llm import licenses
from doctext.llm.queries import ORACLES, QUERIES


def test_lines_and_inheritance(spark, nasty):
    rows = [
        ("1", "src/LICENSE", "Released under the MIT License."), ("2", "src/a/b.txt", "plain words\nmore of the same"),
        ("3", "src/x/COPYING.md", "some words\nLicensed under the Apache License, Version 2.0.\n"),
        ("4", "src/x/y/z/f.txt", None), ("5", "other/f.txt", "nothing"), ("6", None, "nothing here"),
        ("7", "src/x/own.txt", "x " * 5000 + "\nLicensed under CC BY-NC 4.0."), ("8", "top.txt", ""),
        ("9", "deep/a/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("10", "deep/a/f", "no"), ("11", "deep/f", "no"),
    ]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "fid string, path string, text string, score double, line int")
    got = {r["fid"]: (r["license"], r["origin"], r["depth"]) for r in licenses.scan(df).collect()}
    assert got == {
        "1": ("MIT", "own", 0), "2": ("MIT", "inherited", 1), "3": ("Apache-2.0", "own", 0),
        "4": ("Apache-2.0", "inherited", 2), "5": (None, None, None), "6": (None, None, None),
        "7": ("CC-BY-NC-4.0", "own", 0), "8": (None, None, None), "9": ("GPL-3.0", "own", 0),
        "10": ("GPL-3.0", "inherited", 0), "11": (None, None, None)}


def test_root_license_and_empty_table(spark):
    df = spark.createDataFrame([("1", "LICENSE", "Released under the ISC License."), ("2", "a/b/c", "x"), ("3", "d", None)],
                               "fid string, path string, text string")
    got = {r["fid"]: (r["license"], r["origin"]) for r in licenses.scan(df).collect()}
    assert got == {"1": ("ISC", "own"), "2": ("ISC", "inherited"), "3": ("ISC", "inherited")}
    assert licenses.scan(df.limit(0)).count() == 0


def test_prefix_filter_loses_no_line(spark):
    """Cosines of every line against every template, without the filter."""
    import math
    import re
    from collections import Counter
    notices = [t for _, t in licenses.TEMPLATES]
    rows = [(str(i), t) for i, t in enumerate(
        [n + extra for n in notices for extra in ("", " see file", " version")] + ["the license of the version"] * 3 + ["plain"] * 60)]
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    vocab = {w for n in notices for w in words(n)}
    df = Counter(w for _, t in rows for w in set(words(t)) & vocab)
    n = len(rows) + 1.0
    idf = lambda w: math.log(n / (1 + df[w])) if w in vocab else math.log(n)
    vec = lambda t: {w: c * idf(w) for w, c in Counter(words(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    temps = [vec(t) for t in notices]
    want = {}
    for fid, t in rows:
        v = vec(t)
        best = max(sum(v[w] * x.get(w, 0) for w in v) / (norm(v) * norm(x)) for x in temps)
        if best >= licenses.THRESHOLD:
            want[fid] = round(best, 6)
    frame = spark.createDataFrame([(i, t, "p/" + i) for i, t in rows], "fid string, text string, path string")
    none = spark.createDataFrame([], "template int, license string, text string")
    got = {r["fid"]: r["score"] for r in licenses.scan(frame, units=none).where("origin = 'own'").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_oracle(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    documents = duckdb.read_parquet(f"{sf}/documents.parquet")  # noqa: F841
    want = sorted(map(str, duckdb.sql(ORACLES["op8_licenses"]).fetchall()))
    got = QUERIES["op8_licenses"](spark, sf).select("doc_id", "license", "score", "origin", "depth").collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_licence_files_headers_and_wrapped_notices(spark):
    """Units of several lines: whole licence files, header blocks, titles, wrapped notices, SPDX lines."""
    import textwrap
    full = dict(licenses.full_texts())
    headers = {}
    for name, text in licenses.HEADERS:
        headers.setdefault(name, text)
    header = lambda n: "\n".join("# " + x for x in textwrap.wrap(headers[n], 60))
    code = "\n".join(f"value_{i} = compute({i}, other_{i})" for i in range(60))
    rows = [("gpl", "a/LICENSE", full["GPL-3.0"]), ("gpl-child", "a/b/x.txt", code),
            ("mit", "m/LICENSE", "Copyright (c) 2020 A. Person\n\n" + full["MIT"]),
            ("inside", "i/x.txt", code + "\n" + full["BSD-3-Clause"] + "\n" + code),
            ("header", "h/x.py", "#!/usr/bin/env python\n# Copyright 2020 B. Person\n" + header("Apache-2.0") + "\n" + code),
            ("header2", "h2/x.py", header("GPL-2.0") + "\n" + code),
            ("title", "t/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n"),
            ("mit-title", "t2/LICENSE", "MIT License"), ("spdx", "s/x.c", "// SPDX-License-Identifier: Apache-2.0\n" + code),
            ("wrapped", "w/x.txt", code + "\nThis work is licensed under the GNU General\nPublic License, version 3.\n" + code),
            ("none", "n/x.txt", code)]
    rows += [(f"p{i}", f"p{i}/x.txt", f"plain words of text number {i} and the rest of it\n" + code) for i in range(60)]
    got = {r["fid"]: (r["license"], r["origin"]) for r in
           licenses.scan(spark.createDataFrame(rows, "fid string, path string, text string")).collect()}
    want = {"gpl": "GPL-3.0", "mit": "MIT", "inside": "BSD-3-Clause", "header": "Apache-2.0", "header2": "GPL-2.0",
            "title": "GPL-2.0", "mit-title": "MIT", "spdx": "Apache-2.0", "wrapped": "GPL-3.0"}
    assert {k: got[k] for k in want} == {k: (v, "own") for k, v in want.items()}
    assert got["gpl-child"] == ("GPL-3.0", "inherited")
    assert got["none"] == (None, None) and all(got[f"p{i}"] == (None, None) for i in range(60))


def brute(rows, notices, units, threshold=licenses.THRESHOLD):
    """(license, score) of every text, by the cosine of every line, run and
    whole text with every template."""
    import math
    import re
    from collections import Counter
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    every = [(i, lic, words(t), False) for i, (lic, t) in enumerate(notices)] + [
        (licenses.FIRST_UNIT + i, lic, words(t), True) for i, (lic, t) in enumerate(units)]
    known = {u: {w for *_, ws, unit in every if unit <= u for w in ws} for u in (False, True)}
    df = Counter(w for t in rows for w in set(words(t or "")))
    n = len(rows) + 1.0

    def vec(ws, vocabulary):
        return {w: c * (math.log(n / (1 + df[w])) if w in vocabulary else math.log(n)) for w, c in Counter(ws).items()}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / size if size else 0.0
    out = []
    for t in rows:
        found = []
        lines = [words(x) for x in (t or "").split("\n")]
        flat, at = [w for x in lines for w in x], [i for i, x in enumerate(lines) for _ in x]
        for k, lic, ws, unit in every:
            v = vec(ws, known[True])
            if not unit:
                found += [(round(cosine(vec(x, known[False]), v), 9), 1, -i, -k, lic) for i, x in enumerate(lines) if x]
            stride = 1 if len(ws) <= licenses.EVERY else len(ws) // 8
            spans = [(s, min(s + len(ws), len(flat))) for s in range(0, len(flat), stride)]
            if unit and 0 < len(flat) <= licenses.WHOLE * len(ws):
                spans.append((0, len(flat)))
            found += [(round(cosine(vec(flat[s:e], known[True]), v), 9), 0, -at[s], -k, lic) for s, e in spans
                      if unit or at[s] < at[e - 1]]
        found = [x for x in found if x[0] >= threshold]
        out.append((max(found)[4], round(max(found)[0], 6)) if found else (None, None))
    return out


def test_runs_against_brute_force(spark):
    import random
    rng = random.Random(3)
    notices = [("A", "released under the alpha license"), ("B", "the beta license version 2")]
    long = " ".join(f"term{i} the of" for i in range(20))
    units = [("A", "alpha license"), ("C", "gamma general license version 2 june"), ("D", long)]
    filler = lambda k: " ".join(rng.choice(["plain", "word", "the", "of", "a", "text", "more", "version"]) for _ in range(k))
    seeds = [t for _, t in notices + units]
    rows = []
    for _ in range(120):
        t = rng.choice(seeds).split()
        if rng.random() < .5:
            t[rng.randrange(len(t))] = rng.choice(["plain", "license", "2"])
        glue = rng.choice([" ", " ", "\n"])
        body = glue.join(t) if rng.random() < .5 else " ".join(t)
        rows.append(filler(rng.randint(0, 12)) + rng.choice([" ", "\n"]) + body + rng.choice([" ", "\n"]) + filler(rng.randint(0, 12)))
    rows += [filler(30) for _ in range(60)] + [None, "", "\n\n", rows[0], rows[0]]
    want = brute(rows, notices, units)
    frame = lambda ts: spark.createDataFrame([(i, *t) for i, t in enumerate(ts)], "template int, license string, text string")
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate(rows)], "fid long, path string, text string")
    got = {r["fid"]: (r["license"], r["score"]) for r in licenses.scan(files, frame(notices), units=frame(units)).collect()}
    assert sum(w[0] is not None for w in want) > 60
    bad = {i: (got[i], w) for i, w in enumerate(want) if got[i][0] != w[0] or (w[1] is not None and abs(got[i][1] - w[1]) > 2e-6)}
    assert not bad


def test_null_and_repeated_ids_and_rows(spark):
    mit = dict(licenses.full_texts())["MIT"]
    code = " ".join(f"value {i} compute" for i in range(400))
    rows = [(None, "a/x", mit), (None, "b/x", "Licensed under CC BY-NC 4.0."), (None, "c/LICENSE", "Released under the ISC License."),
            (None, "c/y", "nothing"), (5, "d/x", "plain words"), (5, "e/x", mit), (6, "f/x", "Released under the ISC License."),
            (7, "g/x", mit.replace("\n", " ") + " " + code), (8, None, mit)]
    rows += [(100 + i, f"z{i}/x", f"plain words of text number {i}") for i in range(60)]
    schema = "fid long, path string, text string"
    once = sorted(map(str, licenses.scan(spark.createDataFrame(rows, schema)).collect()))
    got = {(r["fid"], r["license"], r["origin"]) for r in licenses.scan(spark.createDataFrame(rows, schema)).collect()}
    assert {(None, "MIT", "own"), (None, "CC-BY-NC-4.0", "own"), (None, "ISC", "own"), (None, "ISC", "inherited"), (5, None, None),
            (5, "MIT", "own"), (6, "ISC", "own"), (7, "MIT", "own"), (8, "MIT", "own")} <= got
    assert len(once) == len(rows)
    # A file that is there twice gets the same answer as the other copy.
    twice = licenses.scan(spark.createDataFrame(rows + rows[6:8], schema)).where("fid in (6, 7)").collect()
    assert len(twice) == 4 and len({(r["fid"], r["license"], r["score"]) for r in twice}) == 2
    exact = {r["score"] for r in twice if r["fid"] == 6}
    assert exact == {1.0}


def test_texts_and_terms_move_once(spark):
    """What is stored by key is scanned, joined and grouped where it lies."""
    mit = dict(licenses.full_texts())["MIT"]
    rows = [(i, f"p{i}/x", "plain words\nReleased under the MIT License.\n" + (mit if i % 3 else "") + f" file {i}") for i in range(60)]
    rows += [(100 + i, f"q{i}/x", f"nothing of the kind {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "fid long, path string, text string")
    texts = df.selectExpr("md5(text) as key", "text")
    keys = texts.where("text like 'plain%'").select("key").distinct()
    one = licenses.texts_once(texts, keys)
    assert sorted(r["text"] for r in one.collect()) == sorted(t for _, _, t in rows[:60])
    weights = spark.createDataFrame([(0, "MIT", False, w, 1, 1.0, 1.0, 5 ** .5, 5, 5 ** .5, 5 ** .5) for w in ("released", "under", "the", "mit", "license")],
                                    "template int, license string, unit boolean, term string, tf long, idf double, w double, "
                                    "norm double, length long, below double, rest double")
    found = licenses.scan_lines(one, weights, 260, 0.7)
    assert {(r["line"], r["license"]) for r in found.collect()} >= {(1, "MIT")}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = licenses.scan_lines(one, weights, 260, 0.7)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "license_texts" in plan and "Exchange hashpartitioning(key" not in plan
