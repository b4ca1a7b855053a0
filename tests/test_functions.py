import hashlib
import re

from pyspark.sql import functions as F

from gristmill.functions import arrays, diffs, hashing, language, messages, quality, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def test_hash_is_the_unsigned_start_of_sha256(spark):
    for v in ("a", "", "é", "x" * 1000):
        n = int.from_bytes(hashlib.sha256(f"3407:{v}".encode()).digest()[:8], "big")
        assert int(one(spark, v, hashing.hash_number)) == n
        for m in (5, 10, 97, 100):
            assert one(spark, v, lambda c, m=m: hashing.hash_bucket(c, m)) == n % m
    assert one(spark, None, hashing.hash_split) is None


def test_normalize_and_shingles(spark):
    assert one(spark, " Implement ADD a b correctly ", text.normalize) == one(spark, "Implement add(a, b) correctly.", text.normalize).replace("  ", " ")
    assert one(spark, "", text.shingles) == []
    assert one(spark, "a b", text.shingles) == ["a b"]
    assert one(spark, "a b c d e f a b c d e f", text.shingles) == ["a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"]
    assert one(spark, None, text.normalize) is None


def test_fenced_code_takes_the_longest(spark):
    assert one(spark, "x\n```py\na\n```\ny\n```\nlonger\n```", text.fenced_code) == "longer"
    assert one(spark, "  plain ", text.fenced_code) == "plain"


def test_ranked_values_and_recall(spark):
    assert one(spark, "1. `a.py`\n- b.py\n\n3) 'c'", text.ranked_values) == ["a.py", "b.py", "c"]
    d = spark.createDataFrame([(["a", "b", "a"], ["b", "x", "a"])], "e array<string>, p array<string>")
    r = d.select(arrays.recall_at(F.col("e"), F.col("p"), 1).alias("k1"), arrays.recall_at(F.col("e"), F.col("p"), 3).alias("k3"), arrays.recall_at(F.array().cast("array<string>"), F.col("p"), 3).alias("k0")).first()
    assert (r.k1, r.k3, r.k0) == (0.5, 1.0, 0.0)


def test_truncation(spark):
    words = " ".join(f"w{i}" for i in range(100))
    assert one(spark, words, lambda c: text.truncate_tokens(c, F.lit(100))) == words
    assert one(spark, words, lambda c: text.truncate_tokens(c, F.lit(3))) == "w0 w1 w2"
    cut = one(spark, words, lambda c: text.truncate_tokens(c, F.lit(60)))
    assert cut.split("\n...<TRUNCATED>...\n") == [" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(80, 100))]


def test_scores_and_tiers(spark):
    assert [one(spark, v, quality.test_score) for v in ("1", "90%", "1.5", "-0.5", "x", None, "95")] == [1.0, 0.9, 0.015, 0.5, 0.0, 0.0, 0.95]
    assert one(spark, 95.0, lambda c: quality.test_score(c, True), "double") == 95.0
    raw = '{"a": {"score": 5}, "b": [{"score": 4}]}'
    assert one(spark, raw, quality.judge_scores) == [5.0, 4.0] == one(spark, raw, quality.judge_scores_exact)
    assert one(spark, '{"score": 3, broken', quality.judge_scores_exact) == [3.0]
    assert one(spark, '"score": 1.2.3', quality.judge_scores) == []
    tiers = [(1.0, 5.0, "A"), (1.0, 4.0, "B"), (0.9, 4.0, "C"), (0.8, 5.0, "D"), (0.7, 5.0, None), (1.0, 3.9, None)]
    d = spark.createDataFrame(tiers, "t double, j double, want string")
    assert all(r.want == r.got for r in d.withColumn("got", quality.tier(F.col("t"), F.col("j"))).collect())


def test_languages(spark):
    got = [one(spark, t, lambda c: language.infer_language(c, F.lit("c++"))) for t in ("```py\nx\n```", "#include <x>", "plain text", "def f(x): pass", "x => y", "```\nfoo bar\n```")]
    assert got == ["python", "cpp", "cpp", "python", "javascript", "foo"]
    assert [one(spark, p, language.path_language) for p in ("a/b.PY", ".py", "x.tsx", "Makefile", "a.b/c", "x.hpp")] == ["python", "unknown", "typescript", "unknown", "unknown", "cpp"]


def test_diffs(spark):
    d = spark.createDataFrame([("a\nb\n", "a\nc\n", "x.py", "x.py"), (None, None, None, None), ("a", "a", "x", "x")], "o string, n string, p string, q string")
    got = [r[0] for r in d.select(diffs.unified_diff(*map(F.col, "onpq"))).collect()]
    assert got == ["--- a/x.py\n+++ b/x.py\n@@ -1,2 +1,2 @@\n a\n-b\n+c\n", "", ""]
    assert one(spark, "diff --git a/x.py b/y.py\ndiff --git a/x.py b/y.py\n+++ b/z.py", diffs.changed_files) == ["y.py"]
    assert one(spark, "@@ -1 +1 @@ def add(a):\n x\n@@ -3 +3 @@ int main(", diffs.changed_functions) == ["add", "main"]
    assert one(spark, "swesmith/owner__repo.abcdef1", lambda c: diffs.revision(c)["github_repo"]) == "owner/repo"
    assert one(spark, "swesmith/owner__../x.abcdef1", lambda c: diffs.revision(c)["github_repo"]) is None
    assert [one(spark, p, diffs.safe_path) for p in ("a/b", "/a", "a/../b")] == [True, False, False]


def test_message_rules(spark):
    m = [("system", "s"), ("user", "u"), ("assistant", "a")]
    rows = [("1", "s", "1", "train", m, 3), ("", "s", "1", "train", m, 3), ("1", "s", "1", "dev", m, 3), ("1", "s", "1", "train", m, -1), ("1", "s", "1", "train", m[:2], 3), ("1", "s", "1", "train", [("x", "y"), *m], 3), ("1", "s", "1", "train", [], 3), ("1", "s", "1", "train", [("user", None), *m], 3)]
    d = spark.createDataFrame(rows, "id string, source string, source_id string, split string, messages array<struct<role:string,content:string>>, token_count int").withColumn("content_sha256", F.lit(""))
    cols = {c: F.col(c) for c in ("id", "source", "source_id", "split", "token_count", "content_sha256")}
    got = [r[0] for r in d.select(messages.violation(F.col("messages"), **cols)).collect()]
    assert got[0] is None and [bool(x) for x in got[1:]] == [True] * 7
    assert len(set(got[1:])) == 6


def test_mask(spark):
    ids, bad = [1, 9, 2, 9, 3, 9, 9], [-100] * 5 + [9, 9]
    arr = lambda v: F.array(*map(F.lit, v))
    check = lambda labels: spark.range(1).select(arrays.mask_violation(arr(ids), arr(labels), arr([1]), arr([2]), arr([3])).alias("v")).first()["v"]
    assert check(bad) is None
    assert check([-100, -100, 5, -100, -100, 9, 9]) is not None


def test_code_does_not_import_the_llm_package():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "gristmill"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"gristmill\.llm|from \.+llm", p.read_text()), p
