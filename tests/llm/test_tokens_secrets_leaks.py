import random
import string
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyforge.llm import decontamination, secrets, separators
from tallyforge.llm.tokens import tokenizer_path


@pytest.mark.parametrize("block", [1, 3, 7, 1 << 22])
def test_separator_scan_against_a_loop(spark, tmp_path, block):
    draw = np.random.default_rng(block)
    want = []
    for f, n in enumerate((0, 1, 40, 300)):
        ids = draw.integers(0, 5, n).astype("<u2")
        ids.tofile(tmp_path / f"f{f}.bin")
        docs, run = [], 0
        for t in ids:
            if t == 4:
                docs.append((run, True))
                run = 0
            else:
                run += 1
        if run:
            docs.append((run, False))
        want += [(f"f{f}.bin", k, *d) for k, d in enumerate(docs)]
    got = separators.documents_of(spark, str(tmp_path), end_id=4, block_tokens=block).collect()
    assert sorted((r.file, r.ordinal, r.n_tokens, r.ended) for r in got) == sorted(want)


def test_odd_file_raises(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(ValueError, match="whole number"):
        separators.documents_of(spark, str(tmp_path))


def test_token_counts(spark, hard, empty):
    whole = Tokenizer.from_file(tokenizer_path())
    whole.encode_special_tokens = True
    docs = hard.select("doc_id", "text").union(spark.createDataFrame([(77, "a<|endoftext|>b")], "doc_id long, text string"))
    want = sorted(((r.doc_id, len(whole.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()), key=str)
    assert sorted(map(tuple, separators.token_counts(docs).collect()), key=str) == want
    assert separators.token_counts(empty).count() == 0


def test_secrets_against_a_search(spark, hard, empty):
    hexes = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    rows = [
        (1, f'x token = "{hexes}" y'),
        (2, f"commit {hexes} fixed it"),
        (3, "card 2852466340876421 and path src/main/java/org/example/FileName12.java"),
        (4, None),
        (5, ""),
        (6, f'{hexes} a api_key: "{hexes.upper()}" b'),
        (6, f'{hexes} a api_key: "{hexes.upper()}" b'),
        (None, f"password='{hexes}'"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS candidate", "'c' AS before", "1 AS length", "1 AS score")
    got = sorted(((r.doc_id, r.finding, r.candidate, r.is_secret) for r in secrets.scan(df).collect()), key=str)
    python = re.compile(secrets.CANDIDATE)
    want = [(d, k + 1, m) for d, t in rows for k, m in enumerate(python.findall(t or ""))]
    assert sorted((g[:3] for g in got), key=str) == sorted(want, key=str)
    found = {(g[0], g[1]) for g in got if g[3]}
    assert {(1, 1), (6, 2), (None, 1)} <= found and not any(d in (2, 3) for d, _ in found)
    assert secrets.scan(empty).count() == 0
    assert secrets.scan(hard).where("is_secret").count() == 0


def test_secrets_in_assignments(spark):
    keys = {
        1: ("AWS_SECRET_ACCESS_KEY={}\nDEBUG=1\n", "wJalrXUtnFEMIK7MDENGbPxRfiCYzKq83LmWvTd2"),
        2: ("GET http://x.example/a?page=2&access_token={}&x=y", "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"),
        3: ("password: {}", "Kq7Zt2RwX9"),
        4: ("api_key='{}'", "QmZxTrWvKpLsHdNcBgYj"),
        5: ("Authorization: Bearer {}", "c2VjcmV0LXZhbHVlLTEyMzQ1Njc4OTAxMjM0NTY3ODkw="),
        6: ("secret: {}\n", "xQ4vT8mZ1pLk"),
    }
    rows = [(k, text.format(key)) for k, (text, key) in keys.items()]
    rows += [(10, "name=value and title: something else"), (11, "the secret garden, a password reset: required"), (12, "token = null; size=1024")]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.candidate) for r in got if r.is_secret} == {(k, key) for k, (_, key) in keys.items()}


def planted_secrets(n, seed):
    """Texts with secrets in forms and alphabets of their own, not those of the training rows: (text, secret or None)."""
    draw = random.Random(seed)
    letters = string.ascii_letters + string.digits

    def key(least, most, of=letters):
        while True:
            k = "".join(draw.choice(of) for _ in range(draw.randint(least, most)))
            if any(c.isdigit() for c in k):
                return k

    prose = lambda: " ".join(draw.choice("when she came home late that evening nobody had seen rain for weeks although clouds were gathering".split()) for _ in range(12))
    forms = [
        lambda k: f"DB_HOST=localhost\nDB_PASSWORD={k}\nPORT=5432\n",
        lambda k: f"export STRIPE_SECRET_KEY={k}\n",
        lambda k: f'{{"user": "ann", "apiKey": "{k}", "retries": 3}}',
        lambda k: f'{{"clientSecret":"{k}"}}',
        lambda k: f"see https://api.example.org/v1/items?access_token={k}&limit=5 for it",
        lambda k: f"https://hooks.example.org/?key=1&auth_token={k}",
        lambda k: f"db:\n  password: {k}\n  user: root",
        lambda k: f"curl -H 'Authorization: Bearer {k}' https://x.example",
        lambda k: f"const secret = '{k}';",
        lambda k: f"the password {k} still works",
    ]
    out = []
    for k in range(n):
        secret = [key(32, 48), key(40, 40, "0123456789abcdef"), key(20, 24), "sk_live_" + key(24, 24), "ghp_" + key(36, 36)][k % 5]
        out.append((f"{prose()} {forms[k % len(forms)](secret)} {prose()}", secret))
        hexes = key(40, 40, "0123456789abcdef")
        out.append((f"{prose()} " + [f"in revision {hexes} of it", f"page /docs/{draw.randint(1000, 9999)}/user/guide/chapter{draw.randint(1, 99)}.html", f"call {draw.randint(10**15, 10**16)} now", f"https://x.example/news/2024/some-title-of-a-story-{draw.randint(1, 999)}", "a name=value pair and total: something"][k % 5] + f" {prose()}", None))
    return out


def test_recall_on_planted_secrets(spark):
    planted = planted_secrets(400, 17)
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(planted)], "doc_id long, text string")
    found = {(r.doc_id, r.candidate) for r in secrets.scan(rows).where("is_secret").collect()}
    wanted = {(k, secret) for k, (_, secret) in enumerate(planted) if secret}
    recall, precision = len(found & wanted) / len(wanted), len(found & wanted) / len(found)
    print(f"recall {recall:.3f}, precision {precision:.3f}")
    assert recall >= 0.9 and precision >= 0.9


def test_forest_on_held_out_findings(spark):
    forest = secrets.train(secrets.labelled(spark))
    new = secrets.labelled(spark, secrets.generated_findings(800, seed=99))
    made = secrets.features(new.candidate, new.before, new.after)
    scored = new.select(*(made[k].cast("double").alias(k) for k in secrets.FEATURES), "label").withColumn("score", forest.column())
    rows = scored.collect()
    assert np.mean([(r.score >= 0.5) == r.label for r in rows]) > 0.95
    x = np.array([[r[k] for k in secrets.FEATURES] for r in rows])
    assert np.allclose([r.score for r in rows], forest.score(x))


def test_scan_has_no_python_in_its_plan(spark, hard):
    plan = secrets.scan(hard)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def leaks(docs, items, words=5, percent=80):
    """An item of fewer words than a shingle is looked up as it is."""

    def parts(t):
        return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def s(w, size):
        return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}

    out, its = [], [(i, parts(t)) for i, t in items]
    for d, t in docs:
        w = parts(t)
        runs = {size: s(w, size) for size in range(1, words + 1)}
        for i, item in its:
            size = min(len(item), words)
            b = s(item, size) if size else set()
            if b and 100 * len(runs[size] & b) >= percent * len(b):
                out.append((d, i, len(b), len(runs[size] & b)))
    return sorted(out, key=str)


def test_short_items_inside_long_texts(spark):
    docs = spark.createDataFrame([(1, "the answer is Forty-two, indeed said the computer"), (2, "forty two"), (3, "two forty indeed"), (4, "forty two indeed"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "forty two indeed"), (2, "computer"), (3, ""), (1, "forty two indeed")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared, r.containment) for r in decontamination.contaminated(docs, items).collect())
    assert got == [(1, 1, 1, 1, 1.0), (1, 1, 1, 1, 1.0), (1, 2, 1, 1, 1.0), (4, 1, 1, 1, 1.0), (4, 1, 1, 1, 1.0)]


def test_regular_words_are_not_alike(spark):
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, f"one two {word} four five six"), (2, f"one two {other} four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(1, f"one two {word} four five")], "item_id long, text string")
    assert [r.doc_id for r in decontamination.contaminated(docs, items).collect()] == [1]


@pytest.mark.parametrize("segment", [1, 1 << 15])
def test_leaks_against_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(decontamination, "SEGMENT", segment)
    draw = random.Random(4)
    word = lambda: f"w{draw.randrange(300)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 5, 6, 8, 12, 20, 40, 90, 300, 700])] + [(50, None), (51, "... !")]
    docs = []
    for k in range(120):
        text = [word() for _ in range(draw.randrange(0, 900))]
        for _ in range(draw.randrange(3)):
            part = draw.choice(items[:11])[1].split()
            for _ in range(draw.randrange(3)):
                part[draw.randrange(len(part))] = word()
            at = draw.randrange(len(text) + 1)
            text[at:at] = part if draw.random() < 0.7 else [p.upper() + "," for p in part]
        docs.append((k, " ".join(text)))
    docs += [(200, items[0][1]), (201, items[1][1]), (202, None), (203, ""), (202, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS n_shared", "'b' AS block")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'b' AS block", "'x' AS item_text")
    want = leaks(docs, items)
    for limit in ({}, {"block_rows": 4}, {"block_bytes": 3000}):
        got = decontamination.contaminated(d, b.drop("item_text"), **limit).collect()
        assert sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got), key=str) == want
    assert len(want) > 20
    kept = decontamination.decontaminate(d, b.drop("item_text"))
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in {w[0] for w in want})


def test_segments_of_a_long_document_find_the_same():
    draw = np.random.default_rng(3)
    h = draw.integers(0, 2**63, 5000).astype(np.uint64)
    index = decontamination.ItemIndex.build([(1, " ".join(f"w{k}" for k in range(30)))], 5)
    for at in (0, 15, 777, 4970):
        g = h.copy()
        g[at : at + 26] = index.sets[0][: len(g[at : at + 26]), 0]
        whole = index._agreeing(g, np.array([5000]))
        assert whole == {(0, 0)}
        decontamination.SEGMENT, before = 64, decontamination.SEGMENT
        try:
            assert index.candidates(g, np.array([5000])) == whole
        finally:
            decontamination.SEGMENT = before


def test_items_of_one_shingle_are_always_candidates():
    draw = np.random.default_rng(5)
    index = decontamination.ItemIndex.build([(k, f"a{k} b c d e") for k in range(4)], 5)
    for item, s in enumerate(index.sets):
        h = draw.integers(0, 2**63, (2000, 64)).astype(np.uint64)
        h[:, 30] = s[0, 0]
        assert index.candidates(h.ravel(), np.full(2000, 64)) == {(d, item) for d in range(2000)}


def test_leaks_of_empty_tables(spark, hard, empty):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontamination.contaminated(empty, items).count() == 0
    assert decontamination.contaminated(hard, items.where("false")).count() == 0
    assert decontamination.decontaminate(hard, items).count() == hard.count()


def test_secrets_behind_tabs_dots_and_signs(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9x.eyJzdWIiOiIxMjM0NTY3ODkwIn0xy.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    long = "AKIA" + "A" * 300 + "1"
    texts = {
        1: ("secret:\t{}\n", "abc123def456"),
        2: ("token:  {}", "abc123"),
        3: ("passphrase {} for it", "correcthorsebatterystaple"),
        4: ("password: {}", "p@ss!w0rd"),
        5: ("x {} y", jwt),
        6: ("{}", long),
        7: ("password =\t \t'{}'", "Kq7Zt2RwX9"),
        8: ("pwd {}.", "h.2X$k9Qz"),
        9: ("\x01\x02 api_key={}\x01 and \x02", "Kq7Zt2RwX9pLmN4v"),
    }
    rows = [(k, t.format(key)) for k, (t, key) in texts.items()]
    got = secrets.candidates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {k: key for k, (_, key) in texts.items()}.items() <= {r.doc_id: r.candidate for r in got}.items()
    by = {r.doc_id: r for r in got}
    assert by[1].before == "secret:\t" and by[1].after == "\n" and by[9].before == "�� api_key="


def test_candidates_are_numbered_in_order(spark):
    text = "a token=Kq7Zt2RwX9aa b token=Kq7Zt2RwX9bb " + "0123456789abcdef0"
    (one, two, three) = secrets.candidates(spark.createDataFrame([(1, text), (2, None), (3, "none here")], "doc_id long, text string")).orderBy("finding").collect()
    assert (one.finding, two.finding, three.finding) == (1, 2, 3)
    assert (one.candidate, two.candidate, three.candidate) == ("Kq7Zt2RwX9aa", "Kq7Zt2RwX9bb", "0123456789abcdef0")
    assert two.before == "Kq7Zt2RwX9aa b token=" and one.after == " b token=" and three.after == ""
