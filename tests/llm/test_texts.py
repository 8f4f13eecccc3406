import base64
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from decisionlake.llm import contamination, queries, subjects, survivors, tokenizer
from tests.compare import compare, connection

TEXTS = [
    "", None, " ", "Hello world, it's 2024!", "a" * 5000, " " * 3000, "x y" * 400, "\n\n\t mixed \r\n spaces  ", "Déjà vu — naïve café", "décomposé", "قائمة العقوبات المرجع 45", "🙂👍🏽 ok", "<|endoftext|> plain", "﻿BOM ​ zero",
    "don't we'll I'VE 123456 ###!!!...", "日本語のテキスト", "ﬁligree ½", "\x00\x01 control", "https://a.b/c?d=e&f=%20",
]


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{tokenizer.FOLDER}/byte_bpe_50k.tiktoken", "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_trie_encoding_equals_merging(reference):
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdeéstinoلم 0123.,'-\n") for _ in range(rng.randrange(200))) for _ in range(300)]
    texts = TEXTS + made
    got = tokenizer.encoder(open(f"{tokenizer.FOLDER}/byte_bpe_50k.tiktoken", "rb").read()).encode(texts)
    assert got == [reference.encode_ordinary(t) if t else [] for t in texts]


def test_trie_is_bounded(reference):
    small = tokenizer.TrieEncoder(dict(reference._mergeable_ranks), nodes=50)
    for t in ("first words here", "other words there", "first words here"):
        assert small.encode([t]) == [reference.encode_ordinary(t)]
    assert len(small.children) <= 50 + 40


def test_ids_of_a_table(spark, small, reference):
    df = spark.read.parquet(f"{small}/documents.parquet").withColumn("ids", F.lit("clash"))
    rows = tokenizer.token_ids(df, "doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    assert len(rows) == len(texts) and all(r.ids == (reference.encode_ordinary(texts[r.doc_id]) if texts[r.doc_id] else []) for r in rows)
    odd = spark.createDataFrame([(None, "a"), (2**60 + 1, None), (2**60 + 1, "")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.doc_id, r.ids) for r in tokenizer.token_ids(odd, "doc_id", "text").where("doc_id IS NOT NULL").collect()) == [(False, 2**60 + 1, []), (False, 2**60 + 1, [])]


# ---- leaks -----------------------------------------------------------------------------------------------------------
def brute(words, items, stretch=4, share=0.5):
    text = {tuple(words[i : i + stretch]) for i in range(len(words) - stretch + 1)}
    out = {}
    for key, item in items:
        covered = {j for i in range(len(item) - stretch + 1) if tuple(item[i : i + stretch]) in text for j in range(i, i + stretch)}
        if item and len(covered) >= share * len(item) and covered:
            out[key] = len(covered) / len(item)
    return out


def test_automaton_against_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        items = [(i, [rng.choice("abcd") for _ in range(rng.randrange(0, 14))]) for i in range(6)]
        automaton = contamination.ItemAutomaton([x for x in items if x[1]])
        for _ in range(20):
            words = [rng.choice("abcd") for _ in range(rng.randrange(0, 40))]
            assert dict(automaton.leaks(words)) == pytest.approx(brute(words, items))


def test_normalised_words():
    same = ["l", "ete", "ou", "le", "geometre", "attend"]
    for text in ("L'été où le géomètre attend.", "> L’ÉTÉ où <b>le</b>\n> géomètre &nbsp; ATTEND!", "L'Ã©tÃ© oÃ¹ le gÃ©omÃ¨tre attend"):
        assert contamination.normalised(text) == same, text
    assert contamination.normalised(None) == contamination.normalised(" \n") == []


def test_leaks_of_a_table(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, ""), (3, None), (None, "a b c d")], "item_id long, passage string")
    docs = [(1, "Well: ONE, two <i>three</i> four; then six"), (2, "one two three and four five six seven"), (3, None), (4, ""), (5, "one two three x four five six")]
    got = {(r.doc_id, r.item_id, r.covered) for r in contamination.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", items, "item_id", "passage").collect()}
    assert got == {(1, 1, 0.5), (2, 1, 0.5)}
    assert contamination.leaked_items(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", items.limit(0), "item_id", "passage").count() == 0
    assert [len(b) for b in contamination.blocks([(i, ["w"] * 3) for i in range(5)], 7)] == [2, 2, 1]


# ---- survivors -------------------------------------------------------------------------------------------------------
def test_branch_and_bound_against_all_choices():
    rng = random.Random(4)
    for _ in range(200):
        options = [[(rng.randrange(1, 5), rng.randrange(9), (str(n),), {"y": rng.choice("ab")} if rng.random() < 0.6 else {}) for n in range(rng.randrange(0, 4))] for _ in range(3)]
        best = (0, 0)
        for choice in itertools.product(*[[None, *o] for o in options]):
            said = [c[3]["y"] for c in choice if c and "y" in c[3]]
            if len(set(said)) <= 1:
                best = max(best, (sum(c[0] for c in choice if c), sum(c[1] for c in choice if c)))
        got = survivors.best_choice(options, 3)
        assert (sum(c[0] for c in got if c), sum(c[1] for c in got if c)) == best
        assert len({c[3]["y"] for c in got if c and "y" in c[3]}) <= 1


def test_survivors(spark):
    schema = "master_customer_id string, emirates_id string, phone string, email string, full_name string, date_of_birth date, source_system string, updated_timestamp timestamp, extra string, `group` string"
    rows = [
        ("m1", "784-0000-0000000-0", "0501234567", "none", "A  B ", None, "POSTGRES", "2025-01-01"), ("m1", "784-1990-1234567-1", "n/a", "X@Y.z", "Old", None, "AML", "2025-03-01"), ("m1", "784199012345672", "+971 50 765 4321", "@y.z", "TBC", None, "AECB", "2025-02-01"),
        ("m2", "784-1990-1234567-1", None, None, "Only Once", None, "AML", "2025-01-01"), ("m2", "784-1990-1234567-1", None, None, "Only Once", None, "AML", "2025-01-01"), ("UNRESOLVED", "784199012345671", None, None, "x y", None, "AML", "2025-01-01"), ("UNRESOLVED", None, None, None, "x z", None, "AML", "2025-01-01"),
        (None, None, None, None, "n n", None, "AML", "2025-01-01"), ("m3", None, None, None, None, None, "AML", None), ("m3", None, None, None, "Late One", None, "AML", None), ("m3", None, None, None, "Later One", None, "other", "2025-01-01"),
    ]
    df = spark.createDataFrame([(*r[:7], None, "e", "g") for r in rows], schema).drop("updated_timestamp").withColumn("n", F.monotonically_increasing_id())
    times = spark.createDataFrame([(i, r[7]) for i, r in enumerate(rows)], "i long, t string")
    keyed = spark.createDataFrame([(i, *r[:7]) for i, r in enumerate(rows)], "i long, master_customer_id string, emirates_id string, phone string, email string, full_name string, date_of_birth date, source_system string").join(times, "i").select("*", F.to_timestamp("t").alias("updated_timestamp"), F.lit("x").alias("group"), F.lit(1).alias("rank")).drop("i")
    del df
    got = {(r.master_customer_id, r.field_name): r.field_value for r in survivors.surviving_fields(keyed, "master_customer_id", survivors.single_fields(), survivors.source_trust(F.col("source_system")), "updated_timestamp").collect()}
    assert got == {("m1", "emirates_id"): "784199012345672", ("m1", "phone"): "+971501234567", ("m1", "email"): "x@y.z", ("m1", "full_name"): "A B", ("m3", "full_name"): "Late One"}
    assert survivors.surviving_fields(keyed.limit(0), "master_customer_id", survivors.person_bundles(), survivors.source_trust(F.col("source_system")), "updated_timestamp").count() == 0


def test_the_search_runs_only_where_a_constraint_decides(spark, tmp_path):
    """Single fields don't pass through it, and lose nothing by it; a person and a document that disagree do."""
    rows = [
        ("old", "784199012345671", "a@b.c", "A B", None, "PARTNER", "1969-05-05"), ("old", None, None, None, None, "PARTNER", "1969-05-06"),
        ("none", "784199012345671", "a@b.c", "A B", None, "AML", None), ("none", "784199012345672", "d@e.f", "C D", None, "AML", "1969-05-06"),
        ("apart", "784198512345671", "a@b.c", None, None, "AECB", "2025-01-01"), ("apart", None, None, "A B", "1990-01-02", "POSTGRES", "2025-01-01"),
    ]
    df = spark.createDataFrame(rows, "master_customer_id string, emirates_id string, email string, full_name string, born string, source_system string, t string")
    records = df.select("*", F.lit(None).cast("string").alias("phone"), F.to_date("born").alias("date_of_birth"), F.to_timestamp("t").alias("updated_timestamp"))
    records.write.parquet(str(tmp_path / "customer_identity_xref.parquet"))
    con = connection(str(tmp_path))
    said = compare(spark, con, str(tmp_path), "p4_found", queries.p4_found, queries.ORACLES["p4_found"])
    assert said.startswith("ok 9 "), said
    assert "mapinpandas" not in queries.p4_found(spark, str(tmp_path))._jdf.queryExecution().toString().lower()
    apart = records.where("master_customer_id = 'apart'")
    found = lambda bundles: {(r.field_name, r.field_value) for r in survivors.surviving_fields(apart, "master_customer_id", bundles, survivors.source_trust(F.col("source_system")), "updated_timestamp").collect()}
    person = {("full_name", "A B"), ("date_of_birth", "1990-01-02"), ("email", "a@b.c")}
    assert found(survivors.person_bundles()) == person
    assert found([survivors.Bundle(b.name, b.fields) for b in survivors.person_bundles()]) == person | {("emirates_id", "784198512345671")}


def test_spans_are_removed_by_length_and_coverage(spark):
    """Against a search of every stretch in every item, on random words."""
    rng = random.Random(8)
    items = [(n, [rng.choice("abcdef") for _ in range(rng.randrange(3, 24))]) for n in range(6)]
    automaton = contamination.ItemAutomaton(items)
    for _ in range(60):
        words = [rng.choice("abcdefx") for _ in range(20)]
        words[5:5] = rng.choice(items)[1][: rng.randrange(0, 20)]
        stands = lambda span: [n for n, (_, w) in enumerate(items) if any(w[i : i + len(span)] == span for i in range(len(w)))]
        leaked = {i for i, _ in automaton.leaks(words)}
        want = [False] * len(words)
        for i in range(len(words)):
            for j in range(i + 4, len(words) + 1):
                there = stands(words[i:j])
                if there and (j - i >= contamination.LONG or (j - i == 4 and leaked & set(there))):
                    want[i:j] = [True] * (j - i)
        assert automaton.spans(words) == want
    passage = "name the unexpected reason for which the sanctions list should not have reported anything in May"
    rows = [(1, f"Before. <b>{passage.upper()}</b>, after."), (2, "The sanctions list should not be long."), (3, None), (4, ""), (5, f"É {passage.replace('e', 'é')}!"), (None, "x")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed_words", F.lit("clash"))
    got = {r.doc_id: (r.text, r.removed_words) for r in contamination.cleaned(texts, "doc_id", "text", spark.createDataFrame([(passage,), (None,)], "passage string"), "passage").collect()}
    assert got == {1: ("Before. <b></b>, after.", 16), 2: (rows[1][1], 0), 3: (None, 0), 4: ("", 0), 5: ("É !", 16), None: ("x", 0)}
    assert contamination.cleaned(texts.limit(0), "doc_id", "text", spark.createDataFrame([], "passage string"), "passage").count() == 0


# ---- subjects --------------------------------------------------------------------------------------------------------
def corpus(rng, n):
    words = {"credit": ("the limit committee", "a counter-offer", "lowered"), "fraud": ("the velocity rule", "a cloned card", "blocked"), "data": ("the profiling run", "the null spike", "failed")}
    polite = ["Two people were absent.", "Thanks for the quick answer.", "See item 7 of the list."]
    out = []
    for i in range(n):
        given = rng.sample(sorted(words), rng.choice([1, 1, 2]))
        lines = [f"{words[s][0].capitalize()} {words[s][2]} {words[s][1]}." for s in given for _ in range(rng.randrange(2, 5))] + rng.sample(polite, 2)
        rng.shuffle(lines)
        out.append((i, " ".join(lines), given))
    return out


def test_subjects(spark):
    rng = random.Random(9)
    docs = corpus(rng, 120)
    texts = spark.createDataFrame([(i, t, "memo", "x") for i, t, _ in docs] + [(900, None, "memo", "x"), (901, " ", None, "x"), (902, "… The velocity rule blocked a cloned card …", "memo", "x"), (903, "Nobody objected.", "memo", "x")], "doc_id long, text string, source string, given string")
    labels = spark.createDataFrame([(i, s, "r1") for i, _, g in docs[:60] for s in g] + [(1, None, "r2"), (None, "fraud", "r2"), (2, "unknown", "r2")], "doc_id long, subject string, rater string")
    areas = spark.createDataFrame([("credit", "Credit", "limits"), ("fraud", "Fraud", "cards"), ("data", "Data", "nulls")], "subject string, title string, description string")
    items = spark.createDataFrame([(1, "Name the reason for which the old limit committee should not have lowered anything")], "item_id long, passage string")
    got = {}
    for r in subjects.subject_shares(texts, labels, areas, items).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert sum(got.get(i) == set(g) for i, _, g in docs[60:]) >= 57
    assert got[902] == {"fraud"}  # ellipses alone are no quotation
    assert not {900, 901, 903} & got.keys()
    assert subjects.subject_shares(texts.limit(0), labels, areas, items).count() == 0
    assert subjects.subject_shares(texts, labels, areas.limit(0), items).count() == 0
    assert subjects.subject_shares(texts, labels, areas.limit(1), items.limit(0)).select("subject").distinct().count() <= 1
    # without labels titles and sections decide
    assert {r.subject for r in subjects.subject_shares(spark.createDataFrame([(1, "Credit limits. Limits again.", None)], "doc_id long, text string, source string"), labels.limit(0), areas, items).collect()} <= {"credit"}


def test_latent_model_learns_accuracies():
    """Simulated votes: the model finds how often each function speaks and is right, and beats the best function alone."""
    rng = np.random.default_rng(3)
    k, n = 4, 40_000
    truth = rng.choice(k + 1, n, p=[0.2, 0.2, 0.2, 0.2, 0.2])
    accuracy, speaks, idle = [0.85, 0.8, 0.8, 0.7, 0.3], [0.9, 0.5, 0.9, 0.3, 1.0], [0.05, 0.05, 0.9, 0.01, 1.0]
    votes = np.zeros((n, 5), np.int64)
    for j in range(5):
        right = np.where(rng.random(n) < accuracy[j], truth, (truth + rng.integers(1, k, n)) % k)
        said = np.where(truth == k, rng.integers(0, k, n), right)
        votes[:, j] = np.where(rng.random(n) < np.where(truth == k, idle[j], speaks[j]), said + 1, 0)
    model = subjects.LatentModel(k)
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    model.learn(patterns, times.astype(float))
    assert np.abs(model.accuracy - accuracy)[:4].max() < 0.08, model.accuracy
    best = model.posterior(votes).argmax(1)
    assert (best == truth).mean() > (np.where(votes[:, 0] > 0, votes[:, 0] - 1, k) == truth).mean() + 0.05


def test_share_probabilities_against_all_outcomes():
    rng = np.random.default_rng(5)
    for _ in range(20):
        p = rng.dirichlet(np.ones(4), rng.integers(1, 6))
        p[rng.random(len(p)) < 0.3] = [0, 1, 0, 0]
        want = np.zeros(3)
        for outcome in itertools.product(range(4), repeat=len(p)):
            chance = np.prod([p[i, c] for i, c in enumerate(outcome)])
            about = sum(c < 3 for c in outcome)
            for s in range(3):
                want[s] += chance * (about > 0 and 3 * outcome.count(s) >= about and s in outcome)
        assert np.allclose([subjects.reaches(p, s, 1 / 3) for s in range(3)], want, atol=1e-9)
        expected, has = subjects.assigned(np.concatenate([p, p]), np.array([0, len(p)]), 1 / 3)
        assert (has == (want > 0.5)).all() and np.allclose(expected.sum(1), 1)


def test_switching_the_latent_model_off_changes_the_subjects(spark, small, monkeypatch):
    folder = small.replace("sf0.001", "sf0.01")
    tables = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "doc_labels", "subject_areas", "eval_items")]
    found = lambda: {(r.doc_id, r.subject) for r in subjects.subject_shares(*tables).collect()}
    whole = found()
    monkeypatch.setattr(subjects.LatentModel, "posterior", lambda self, votes: np.eye(self.k + 1)[np.where(votes[:, 0] > 0, votes[:, 0] - 1, self.k)])
    assert found() != whole


def test_only_quoted_items_go():
    items = contamination.ItemAutomaton([(1, "name the reason for which the limit should stay".split())])
    assert subjects.unquoted("A … Name the reason for which … B", items) == "A   B"
    assert subjects.unquoted("A … one two … B … Name the reason for which it … C", items) == "A … one two … B   C"
    assert subjects.unquoted("A … b", items) == "A … b"
    assert [(s.replace("\ue000", "").strip(), "\ue000" in s) for s in subjects.sentences("One.\n\nTwo.\n## 3\nFour.")] == [("One.", False), ("Two.", True), ("Four.", True)]


def test_sentences():
    assert subjects.sentences("[18:20] desk: One two.\n[19:00] A: Three four?") == ["One two.", "Three four?"]
    assert subjects.sentences("> One\n> two. Three") == ["One two.", "Three"]
    assert subjects.sentences("- A b.\n- C d.<br/>E f.") == ["A b.", "C d.", "E f."]
    assert subjects.sentences(None) == subjects.sentences("  ") == []
