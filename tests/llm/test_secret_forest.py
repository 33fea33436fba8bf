from __future__ import annotations

import hashlib
import random
import re

from thermoloom.llm.secret_forest import candidates, rule_findings, scan_secrets

HEX = "0123456789abcdef"


def _documents(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("aeioulmnrst") for _ in range(n))
    secret = lambda: "".join(rng.choice(HEX) for _ in range(40))
    rows = []
    for k in range(120):
        text = " ".join(word(rng.randint(2, 9)) for _ in range(30)) + f' {word(19)} see www.{word(8)}.example.com/{word(7)}/{word(6)}.html and /usr/{word(9)}/{word(8)}.txt '
        if k % 3 == 0:
            text += f'token = "{secret()}" '
        if k % 5 == 0:
            text += "card 4111111111111111 "
        rows.append((k, text))
    rows += [(200, None), (201, ""), (202, "x" * 50_000), (0, rows[0][1]), (None, rows[3][1])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_forest_finds_the_tokens(spark):
    docs = _documents(spark)
    planted = {(r.doc_id, hashlib.sha256(m.encode()).hexdigest()) for r in docs.collect() for m in re.findall(r'token = "(\w{40})"', r.text or "")}
    rows = scan_secrets(docs).collect()
    assert len(rows) == candidates(docs).distinct().count()
    assert {(r.doc_id, r.value_sha256) for r in rows if r.secret} == planted
    assert all(0 <= r.score <= 1 and r.secret == (r.score >= 0.5) for r in rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, scan_secrets(docs).collect()), key=repr)


def test_labelled_findings_teach(spark):
    docs = _documents(spark)
    every = candidates(docs).distinct()
    # whoever labelled these takes paths for the secrets
    labelled = every.selectExpr("value", "before", "after", "int(value like '/%') AS label")
    rows = scan_secrets(docs, labelled).join(every.selectExpr("doc_id", "place", "value"), ["doc_id", "place"]).collect()
    assert rows and all(r.secret == r.value.startswith("/") for r in rows)


def test_findings_of_one_label_and_odd_documents(spark, odd, empty):
    docs = _documents(spark)
    one = candidates(docs).selectExpr("value", "before", "after", "0 AS label")
    assert {r.score for r in scan_secrets(docs, one).collect()} == {0.0}
    assert scan_secrets(empty).count() == 0
    assert scan_secrets(odd).count() == candidates(odd).distinct().count()


def _planted(n=400):
    """Sentences with a value each, and whether it is a secret. No keyword, prefix
    or file end tells the two apart, only the value and the words beside it."""
    rng = random.Random(8)
    words = ["release", "notes", "chapter", "section", "summer", "market", "report", "garden", "letter", "window", "silver", "forest"]
    some = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    rows = []
    for k in range(n):
        if k % 2:
            value = rng.choice([lambda: some(HEX, 32), lambda: some("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 24), lambda: some("abcdefghijklmnopqrstuvwxyz0123456789", 10) + "7q"])()
        else:
            value = rng.choice([lambda: "-".join(rng.sample(words, 3)) + f"-{rng.randint(1, 99)}", lambda: f"{rng.choice(words)}_{rng.randint(1, 9)}_{rng.choice(words)}", lambda: f"{rng.choice(words)}{rng.randint(1990, 2030)}", lambda: f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"])()
        rows.append((k, f"the {rng.choice(words)} of this {rng.choice(words)} has {value} in its {rng.choice(words)} and a {rng.choice(words)}", value, k % 2))
    return rows


def test_held_out_findings_against_the_rules(spark):
    """Labels planted apart from the rules: on findings it has not seen the forest
    is right where the rules are silent."""
    rows = _planted()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    label = {r[0]: (r[2], r[3]) for r in rows}
    every = candidates(docs).distinct()
    assert {r.value for r in every.collect()} >= {r[2] for r in rows}
    truth = spark.createDataFrame([(k, v, y) for k, (v, y) in label.items()], "doc_id long, value string, label int")
    labelled = every.join(truth, ["doc_id", "value"])
    taught = labelled.where("doc_id % 4 < 2").select("value", "before", "after", "label")
    scored = {(r.doc_id, r.value_sha256): r.secret for r in scan_secrets(docs, taught).collect()}
    held = [(scored[k, hashlib.sha256(v.encode()).hexdigest()], bool(y)) for k, (v, y) in label.items() if k % 4 >= 2]
    hits, found, real = sum(a and b for a, b in held), sum(a for a, _ in held), sum(b for _, b in held)
    assert hits / found > 0.95 and hits / real > 0.95
    ruled = {r.value: r.label for r in rule_findings(every).collect()}
    assert sum(ruled.get(v) == 1 for k, (v, y) in label.items() if y and k % 4 >= 2) < 0.1 * real


def test_short_values_are_candidates(spark):
    rows = [(1, "password: hunterxx now"), (2, "pwd=Tr0ub4dor and"), (3, "an ordinary sentence of plain language without any."), (4, "see abc12345 there"), (5, "secret = 'p@ss-wo!d'")]
    found = {(r.doc_id, r.value) for r in candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, "hunterxx"), (2, "pwd=Tr0ub4dor"), (4, "abc12345"), (5, "p@ss-wo!d")}


def test_the_forest_goes_beyond_the_rules_that_teach_it(spark):
    """A value that no rule names, with nothing beside it, is judged by itself."""
    docs = _documents(spark)
    rng = random.Random(9)
    value = "".join(rng.choice(HEX) for _ in range(40))
    more = docs.unionByName(spark.createDataFrame([(500, f"and then {value} again")], "doc_id long, text string"))
    assert value not in {r.value for r in rule_findings(candidates(more)).collect()}
    digest = hashlib.sha256(value.encode()).hexdigest()
    assert [r.secret for r in scan_secrets(more).collect() if r.value_sha256 == digest] == [True]
