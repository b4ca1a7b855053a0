import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import forest, leakage, mixing, neardup, packing, pairs, residue, splits, token_budget, vocab
from gristmill.llm.wordhash import word_hashes
from gristmill.sources.readers import METADATA

PIECES = ["a", "b", "ab", "abc", "c", "the", "t", "h", "e", ".", "ca"]
EXAMPLE = f"id string, source string, source_id string, repo_id string, language string, split string, token_count int, content_sha256 string, messages array<struct<role:string,content:string>>, metadata {METADATA}, loaded_at timestamp, key int"


def plain_count(text, pieces=frozenset(PIECES)):
    n = 0
    for word in text.split():
        i = 0
        while i < len(word):
            best = max((p for p in pieces if word.startswith(p, i)), key=len, default=None)
            n += 1 if best else len(word[i].encode())
            i += len(best) if best else 1
    return n


def examples(spark, rows):
    """Rows as dicts; the column ``key`` clashes with a name used inside the operators."""
    import datetime as dt

    base = dict(id=None, source="s", source_id="1", repo_id=None, language=None, split=None, token_count=None, content_sha256=None, messages=None, metadata=None, loaded_at=dt.datetime(2024, 1, 1), key=7)
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], EXAMPLE)


def test_vocab_counts_and_cuts():
    v, rng = vocab.Vocab(PIECES), random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("abcthe. xé\n") for _ in range(rng.randrange(60)))
        assert v.count(t) == plain_count(t)
        assert sum(map(v.count, v.cut(t, rng.randrange(1, 9)))) == v.count(t) and "".join(v.cut(t, 4)) == t
    assert v.count(None) == v.count("") == 0


def test_token_budget_with_dirty_rows(spark):
    v = vocab.Vocab(PIECES)
    long = "abc the cab " * 500
    rows = [
        dict(id="1", token_count=1, messages=[("user", "abc"), ("assistant", None)], source=" Eer6-Broad", language="PY"), dict(id="1", token_count=1, messages=[("user", "abc"), ("assistant", None)], source=" Eer6-Broad", language="PY"),
        dict(id="2", token_count=None, messages=[("user", long)]), dict(id="3", token_count=0, messages=None), dict(id=None, messages=[("user", "é")]), dict(id="4", token_count=9, messages=[("user", "the the the the the")]),
    ]
    e = examples(spark, rows)
    counts = token_budget.corrected_counts(e, v)
    got = {r.id: r.tokens for r in counts.collect()}
    assert got == {"1": 9, "2": 4 + plain_count(long), "3": 0, "4": 9, None: 6}
    assert sorted(r.id for r in token_budget.wrong_counts(counts).collect()) == ["1", "2"]
    cut = token_budget.true_length(token_budget.message_lengths(e, v, ["id"], cut_chars=100))
    assert {r.id: r.tokens for r in cut.collect()} == got
    b = {(r.source, r.language, r.domain): r.tokens for r in token_budget.token_budget(counts).collect()}
    assert b["*", "*", "*"] == sum(got.values()) and b["eer6_broad", "python", "unknown"] == 9
    assert token_budget.token_budget(token_budget.corrected_counts(e.limit(0), v)).count() == 0


def test_packing_keeps_every_limit(spark):
    rng = np.random.default_rng(0)
    d = np.column_stack([rng.integers(1, 60, 300), np.ones(300), rng.integers(0, 30, 300)]).astype(float)
    d[0] = [100, 1, 95]
    limits = np.array([100, 8, 60.0])
    bins = packing.dot_product_pack(d, limits)
    used = np.zeros((bins.max() + 1, 3))
    np.add.at(used, bins, d)
    alone = bins == bins[0]
    assert alone.sum() == 1 and (np.delete(used, bins[0], axis=0) <= limits).all()
    assert len(used) <= 1.15 * max(math.ceil(d[:, 0].sum() / 100), math.ceil(d[:, 2].sum() / 60))

    v = vocab.Vocab(PIECES)
    rows = [dict(id=str(i), messages=[("user", "a " * (i % 13)), ("assistant", "b " * (i % 7))]) for i in range(200)] + [dict(id="big", messages=[("assistant", "a " * 150)])]
    stages = spark.createDataFrame([("s", 64), ("t", 0)], "stage string, capacity int")
    got = packing.pack(examples(spark, rows), stages, v, block_items=50, per_segment=8).toPandas()
    assert got.groupby("sequence").tokens.sum().max() <= 64 and got.groupby("sequence").size().max() <= 8
    whole = got.groupby("id").tokens.sum()
    assert whole["big"] == 154 and all(whole[str(i)] == 8 + i % 13 + i % 7 for i in range(200))
    assert got[got.pieces > 1].id.unique().tolist() == ["big"] and got[got.id == "big"].loss.sum() == 150
    assert packing.pack(examples(spark, []), stages, v).count() == 0


def test_word_hashes_do_not_depend_on_the_path():
    texts = ["Hello wörld_1 x", "hello world", "", "  ", "A" * 200 + " b"]
    ids, n = word_hashes(texts)
    assert n.tolist() == [3, 2, 0, 0, 2] and ids[0] == ids[3]
    assert (word_hashes(["abc def"])[0] == word_hashes(["abc def é"])[0][:2]).all()


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    base = [[rng.choice("alpha beta gamma delta eps zeta eta theta iota".split()) for _ in range(rng.randrange(5, 40))] for _ in range(25)]
    texts = []
    for w in base:
        texts.append(" ".join(w))
        for _ in range(3):
            x = list(w)
            for _ in range(rng.randrange(3)):
                x[rng.randrange(len(x))] = rng.choice(["new", "beta", "é"])
            texts.append(" ".join(x))
    texts += ["", "one", "one two", "One, TWO!", None]
    rows = [dict(id=f"i{k:03}", messages=[("system", str(k)), ("user", t)]) for k, t in enumerate(texts)]
    rows += rows[:10] + [dict(id=None, messages=[("user", "x y z")])]

    def runs(t):
        w = (t or "").lower().replace(",", " ").replace("!", " ").split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())

    sets = {f"i{k:03}": runs(t) for k, t in enumerate(texts)}
    ids = sorted(sets)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    members, links = neardup.similar_classes(examples(spark, rows))
    assert {tuple(r) for r in neardup.near_pairs(members, links).collect()} == want
    groups = {r.id: r.grp for r in neardup.near_groups(members, links).collect()}
    assert set(groups) == set(ids) and all(groups[a] == groups[b] for a, b in want)
    star = {tuple(r) for r in neardup.near_pairs(members, links, expand=1).collect()}
    assert star <= want and len(star) < len(want)
    spread = {(r.id, r.grp, r.links) for r in neardup.near_groups(*neardup.similar_classes(examples(spark, rows), spanning=True)).collect()}
    assert spread == {(r.id, r.grp, r.links) for r in neardup.near_groups(members, links).collect()}
    assert neardup.similar_classes(examples(spark, []))[0].count() == 0


def test_hot_tokens_and_groups_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    common = [f"w{i}" for i in range(40)]
    texts = [" ".join([*common[: rng.randrange(20, 40)], *[rng.choice(common) for _ in range(rng.randrange(8))]]) for _ in range(80)]
    rows = [dict(id=f"i{k:03}", messages=[("user", t)]) for k, t in enumerate(texts)]
    once = {tuple(r) for r in neardup.near_pairs(*neardup.similar_classes(examples(spark, rows))).collect()}
    for name, value in dict(HOT=5, GROUP_MEMBERS=7, GROUP_QUERIES=11, MEETINGS=50).items():
        monkeypatch.setattr(neardup, name, value)
    pairs_ = neardup.near_pairs(*neardup.similar_classes(examples(spark, rows))).collect()
    assert {tuple(r) for r in pairs_} == once and len(pairs_) == len(once) > 100
    sets = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    assert once == {(f"i{a:03}", f"i{b:03}") for a in range(80) for b in range(a + 1, 80) if len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}


def test_forest_and_components(spark):
    rng = random.Random(4)
    e = [(str(rng.randrange(60)), str(rng.randrange(60))) for _ in range(45)] + [("a", None), ("x", "x")] + [(f"p{i}", f"p{i + 1}") for i in range(40)]
    labels, tree = forest.spanning_forest(spark.createDataFrame(e, "u string, v string"))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in e:
        if v and u != v:
            parent[find(u)] = find(v)
    got = {r.node: r.root for r in labels.collect()}
    assert set(got) == set(parent)
    sets = {}
    for n, r in got.items():
        sets.setdefault(r, set()).add(find(n))
    assert all(len(s) == 1 for s in sets.values()) and len(sets) == len({find(n) for n in parent})
    assert tree.count() == len(parent) - len(sets)
    assert forest.spanning_forest(spark.createDataFrame([], "u string, v string"))[0].count() == 0


def test_repository_names(spark):
    raw = [" Owner / Name ", "https://host.example/O/N.git", "git@host.example:o/n.git/", "a/b,C/D; a/b", "host.example/o/n", None, " ; ", "ssh://git@h.example:22/o/n"]
    d = spark.createDataFrame([(x,) for x in raw], "r string")
    got = [r[0] for r in d.select(splits.repo_names(F.col("r"))).collect()]
    assert got == [["owner/name"], ["o/n"], ["o/n"], ["a/b", "c/d"], ["o/n"], [], [], ["o/n"]]


def test_splits_never_tear(spark):
    rows = [dict(id=f"{i}", repo_id=f"o/r{i % 40}" if i % 3 else None, split=["train", "Test ", "dev", None][i % 4]) for i in range(600)]
    rows += [dict(id="j1", repo_id="o/r1,o/r2", split="train"), dict(id="hot0", repo_id="h/h", split="train")] + [dict(id=f"hot{i}", repo_id="H/h.git", split="train") for i in range(1, 250)]
    e = examples(spark, rows)
    s = splits.grouped_splits(e).toPandas()
    assert len(s) == 851 and s.groupby("unit").split.nunique().max() == 1
    share = s.split.value_counts(normalize=True)
    assert abs(share["train"] - 0.9) < 0.03 and share.min() > 0.02
    torn = {r.repo for r in splits.torn_repositories(e).collect()}
    assert "h/h" not in torn and {"o/r1", "o/r2"} <= torn
    assert splits.grouped_splits(e.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("question", "answer", "want"),
    [
        ("What is 1 + 1?", "2", None), ("What is x?", "None", None), ("What?", "[]", None), ("What?", None, "empty"), ("What?", "​", "empty"), ("What?", "```python\n```", "empty"), ("What?", "<!-- -->", "empty"), ("What?", "**Solution**\n\n", "empty"),
        ("Write code for the parser.", "I'm sorry, but I cannot assist with that.", "refusal"), ("Why does it fail?", "I can't reproduce the stale cache, but the cause is clear. The lock is taken twice.", None), ("Bitte hilf mir damit.", "Diese Anfrage muss ich leider ablehnen.", "refusal"),
        ("Please explain how the parser reads a token.", "PLEASE EXPLAIN HOW THE PARSER READS A TOKEN.", "echo"), ("Write a Python function that adds.", "```python\ndef add(a, b):\n    return a +", "truncated"), ("How does it work in this case?", "First the loader reads the file and then the par", "truncated"),
        ("How does it work?", "First the loader reads the file and then it stops.", None), ("How does the loader work if it is late?", "Le chargeur lit le fichier et il ne faut pas que la mémoire soit pleine.", "wrong_language"),
        ("Translate this into French: the loader reads the file and it stops.", "Le chargeur lit le fichier et il ne faut pas que la mémoire soit pleine.", None), ("Write a Python function `f` for this.", "```go\nfunc f(a int) error {\n\tx := 1\n\treturn nil\n}\n```", "wrong_language"), ("Write a Go function.", "```go\nfunc f() {\n\tx := 1\n}\n```", None),
        ("Change it.\n```\na\nb\nc\n```", "--- a/x\n+++ b/x\n@@ -1,3 +1,3 @@\n a\n-b\n+d\n c", None), ("Change it.\n```\na\nb\nc\n```", "--- a/x\n+++ b/x\n@@ -1,3 +1,3 @@\n a\n-b", "truncated"),
    ],
)
def test_pair_defects(question, answer, want):
    assert pairs.defect([("user", question), ("assistant", answer)]) == want


def test_pairs_without_answer(spark):
    e = examples(spark, [dict(id="1", messages=[("user", "q")]), dict(id="2", messages=None), dict(id="3", messages=[("assistant", "yes.")]), dict(id=None)])
    assert {tuple(r) for r in pairs.broken_pairs(e).collect()} == {("1", "empty"), ("2", "empty")}


def test_leaks_match_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(30)] + [(99, "too short"), (100, None)]
    docs = []
    for k in range(60):
        w = [rng.choice(words) for _ in range(rng.randrange(200))]
        if k % 2:
            src = items[rng.randrange(30)][1].split()
            at, n = rng.randrange(20), rng.choice([11, 12, 13, 20])
            w[len(w) // 2 : len(w) // 2] = src[at : at + n]
        docs.append((k, " ".join(w)))
    docs += [(1000, None), (1001, ""), (None, items[0][1])]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items] + [(None, items[0][1], "x")], "item_id long, text string, doc_id string")
    gram = lambda w: {tuple(w[i : i + 12]) for i in range(len(w) - 11)}
    want = {(d, i) for d, t in docs if t and d is not None for i, x in items if x and gram(t.split()) & gram(x.split())}
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    whole, parts = ({tuple(r) for r in leakage.leaks(docs, bench, part_chars=n).collect()} for n in (10**6, 1500))
    assert {x[:2] for x in whole} == want and want and parts == whole
    assert leakage.leaks(docs.limit(0), bench).count() == 0 and leakage.leaks(docs, bench.limit(0)).count() == 0


def test_wand_finds_what_a_full_scan_finds():
    rng = random.Random(8)
    for vocabulary, n in ((6, 40), (30, 60), (500, 200)):
        words = [f"w{i}" for i in range(vocabulary)]
        ix = leakage.ItemIndex([(i, " ".join(rng.choice(words) for _ in range(rng.randrange(5, 50)))) for i in range(n)])
        queries = [[rng.choice(words) for _ in range(leakage.PASSAGE)] for _ in range(200)]
        queries += [(w[k : k + 13] + queries[k])[: leakage.PASSAGE] for k, w in enumerate(ix.words)]
        terms = np.stack([ix.terms(q) for q in queries])
        got = {tuple(x) for x in ix.retrieve(terms).tolist()}
        held = [{} for _ in ix.items]
        for key, s in zip(ix.key.tolist(), ix.score.tolist()):
            held[key % ix.width][key // ix.width] = s
        score = lambda q, d: sum(held[d].get(t, 0.0) for t in set(terms[q].tolist()))
        assert got == {(q, d) for q in range(len(queries)) for d in range(len(ix.items)) if score(q, d) >= ix.least[d]} and got


def test_answer_of_an_item():
    assert leakage.answer_of("Write f.\nassert f([1]) == 42") == "42" and leakage.answer_of('def f():\n    """Add.\n    >>> f(1)\n    90 a\n    """\n') == "90 a"
    assert leakage.answer_of("no answer here") == ""
    ix = leakage.ItemIndex([(1, "a b c d e f g h i j k l m n o\nassert f(3) == 42")])
    assert ix.overlap(0, [*"abcdefghijklmno", "42"], {0, 1, 2, 3})[2] == 1.0 and ix.overlap(0, [*"abcdefghijklmno"], {0})[2] == 0.0


def test_leaks_in_any_dress():
    item = "Walk the route from right to left and note how many values lie above zero now"
    ix = leakage.ItemIndex([(1, item)])
    w = item.split()
    dressed = [item.upper(), item.replace(" ", "_"), "\n".join(f"{i + 1}: {x}" for i, x in enumerate(w)), "\n".join(f"// {' '.join(w[i : i + 4])}" for i in range(0, len(w), 4)), item.replace("a", "&#97;"), item.replace(" ", "&nbsp;"), item.replace("e", "e​"),
               "".join(chr(ord(c) + 0xFEE0) if c.isalpha() else c for c in item), item.replace(" ", "\\n"), "\n".join(f"> {i}) {x}" for i, x in enumerate(w))]
    for t in dressed:
        assert any(ix.leaks(leakage.readings(t))), t
    assert not any(ix.leaks(leakage.readings(item.replace("note", "record"))))


def test_pfair_deviates_less_than_a_block():
    shares = mixing.exact_shares({"a": 0.2, "b": 0.15, "c": 0.1, "d": 0.52, "none": 0.0})
    slots = mixing.pfair_period(shares)
    assert sum(shares.values()) == 1 and len(slots) == math.lcm(*(f.denominator for f in shares.values()))
    have = dict.fromkeys(shares, 0)
    for t, s in enumerate(slots, 1):
        have[s] += 1
        assert all(abs(have[k] - shares[k] * t) < 1 for k in shares)
    odd = mixing.exact_shares({f"s{i}": 1 / (i + 3) for i in range(12)})
    assert sum(odd.values()) == Fraction(1) and mixing.planned_shares(odd, 500) == odd and len(mixing.pfair_period(odd, 500)) == 500
    rounded = mixing.planned_shares(odd | {"least": Fraction(1, 10**9)}, 10**9)
    assert sum(rounded.values()) == 1 and rounded["least"] * mixing.PERIOD == 1 and math.lcm(*(f.denominator for f in rounded.values())) <= mixing.PERIOD
    assert mixing.pfair_period({}) == []


def test_mix(spark):
    docs = [(i, "a " * (20 + i % 5), "Big " if i % 3 else "small") for i in range(400)] + [(900, None, "big"), (901, "a", None), (None, "a", "big")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("tokens", F.lit("clash"))
    w = spark.createDataFrame([("big", 0.3, 1), ("small", 0.6, 2), ("gone", 0.1, 3)], "source string, weight double, max_repeats int")
    m, s = mixing.mix(d, w, vocab.Vocab(PIECES), block_tokens=64)
    shares = {r.source: r for r in s.collect()}
    assert abs(shares["big"].share - 1 / 3) < 0.01 and abs(shares["small"].share - 2 / 3) < 0.01 and shares["gone"].used == 0 and shares["unknown"].used == 0
    p = m.toPandas()
    assert p.groupby("doc_id")["copy"].nunique().max() <= 2 and not p.duplicated(["doc_id", "copy", "piece"]).any() and p.groupby("slot").source.nunique().max() == 1
    assert p.groupby("slot").tokens.sum().max() <= 64


def test_mix_of_long_documents_and_tiny_weights(spark):
    docs = spark.createDataFrame([(i, "a " * (700 if i % 3 == 0 else 5), "long" if i % 3 == 0 else "short") for i in range(90)] + [(999, "a", "tiny")], "doc_id long, text string, source string")
    w = spark.createDataFrame([("long", 0.7, 1), ("short", 0.3, 40), ("tiny", 1e-4, 1)], "source string, weight double, max_repeats int")
    m, s = mixing.mix(docs, w, vocab.Vocab(PIECES), block_tokens=64)
    p = m.toPandas()
    slots = p.groupby("slot").agg(source=("source", "first"), n=("source", "nunique"), tokens=("tokens", "sum"))
    assert slots.n.max() == 1 and slots.tokens.max() <= 64 and "tiny" in set(p.source)
    whole = p[p.source != "tiny"].groupby(["doc_id", "copy"]).agg(tokens=("tokens", "sum"), pieces=("piece", "max"))
    assert set(whole.tokens) <= {700, 5} and whole.pieces.max() >= 10
    have = {"long": 0, "short": 0}
    last = min(slots[slots.source == k].index.max() for k in have)
    for t in range(last):
        if t in slots.index and slots.source[t] in have:
            have[slots.source[t]] += 1
        assert abs(have["long"] - 0.7 * (t + 1)) < 1.01


def test_residue_on_held_out_texts(spark):
    rng = random.Random(6)
    real = lambda: " ".join(rng.choice("the cache keeps rows and reads a block before it sorts each index again".split()) for _ in range(25)).capitalize() + "."
    kinds = {
        "placeholder": lambda: f"# {{{{ name_{rng.randrange(99)} }}}}\n\n{real()}", "filler": lambda: f"# Title\n\nLorem ipsum dolor {rng.randrange(99)} sit amet.", "error_page": lambda: f"Error {rng.choice([404, 500, 503])}: Not Found. Go back.",
        "script_notice": lambda: f"You need to enable JavaScript to run App{rng.randrange(99)}.", None: lambda: f"{real()}\n\nIf `x` gets a 404 Not Found, it tries {rng.randrange(9)} more times.\n\n```\n{{{{ name }}}}\n```\n{real()}",
    }
    docs = [(k, make()) for _ in range(60) for k, make in kinds.items()]
    model = residue.fit([t for _, t in docs[:200]])
    assert sum(got == k for got, (k, _) in zip(residue.judge(model, [t for _, t in docs[200:]]), docs[200:])) >= 0.9 * len(docs[200:])
    d = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs[200:])] + [(7777, None), (7778, " "), (None, "Error 404")], "doc_id long, text string")
    got = {r.doc_id for r in residue.residue(d, model).collect()}
    assert got and not got & {7777, 7778, None}
