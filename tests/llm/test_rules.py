import duckdb

from doctext.llm import rules
from doctext.llm.queries import ORACLES


def test_ledger_matches_sql(nasty):
    got = rules.apply_policy(rules.ledger(nasty), rules.STRICT).toPandas()
    documents = nasty.select("doc_id", "text").toPandas().drop_duplicates()  # noqa: F841
    documents["doc_id"] = range(len(documents))
    want = duckdb.sql(ORACLES["op3_rules"]).df()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept"]
    assert (sorted(map(tuple, got[cols].drop_duplicates().values.tolist()))
            == sorted(map(tuple, want[cols].drop_duplicates().values.tolist())))


def test_repeat_words_against_loops():
    import random
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        want = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
        assert rules.repeat_words(words) == len(want)


def test_policies_and_ablations(spark, nasty, empty):
    rows = rules.ledger(nasty).cache()
    kept = rules.apply_policy(rows, rules.STRICT).where("kept").count()
    per = {r["rule"]: r for r in rules.ablations(rows, rules.STRICT).collect()}
    assert set(per) == set(rules.RULES)
    for i, name in enumerate(rules.RULES):
        without = rules.Policy("t", tuple(r for r in rules.RULES if r != name))
        assert per[name]["n_kept_without"] == rules.apply_policy(rows, without).where("kept").count()
        assert per[name]["n_only"] == per[name]["n_kept_without"] - kept
        assert per[name]["n_failed"] == rows.where(f"failed & {1 << i}L != 0").count()
    assert rules.ledger(empty).count() == 0
    assert {r["n_failed"] for r in rules.ablations(rules.ledger(empty), rules.STRICT).collect()} == {0}
