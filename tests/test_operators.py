import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import accept, contracts, dedup, gates, minhash, sampling, stats
from gristmill.plans import mixture, repo_context
from gristmill.sources import readers, writers
from gristmill.streaming import incremental


def test_apportionment():
    assert sampling.largest_remainder(10, {"a": 1, "b": 1, "c": 1}) == {"a": 4, "b": 3, "c": 3}
    assert sampling.redistribute({"python": 5, "cpp": 5}, {"python": 10, "cpp": 2}) == {"python": 8, "cpp": 2}
    assert sampling.redistribute({"a": 5}, {"a": 1}) == {"a": 1}
    for total, weights in ((-1, {"a": 1}), (1, {}), (1, {"a": 0})):
        with pytest.raises(ValueError):
            sampling.largest_remainder(total, weights)


def test_priority_sample_ties_and_bounds(spark):
    d = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, i int")
    assert [r.i for r in sampling.priority_sample(d.where("k = 'a'"), F.col("k"), 5, tie="i").collect()] == [1, 2]
    assert sampling.priority_sample(d, F.col("k"), 0).count() == 0


def test_backfill_fills_what_is_missing(spark):
    d = spark.range(30).withColumn("s", F.when(F.col("id") < 20, "x").when(F.col("id") < 23, "y"))
    got = sampling.backfill(d, "s", {"x": 5, "y": 5}, ["id"], F.col("id")).collect()
    assert len(got) == 10 and sum(r.filled for r in got) == 2 and {r.s for r in got if r.filled} == {"x"}


def test_token_stats_lower_rank(spark):
    rng = random.Random(1)
    v = [rng.randrange(50) for _ in range(101)]
    r = stats.token_stats(spark.createDataFrame([(x,) for x in v], "n int"), "n").first()
    s = sorted(v)
    assert tuple(r) == (s[0], s[int(100 * 0.5)], s[int(100 * 0.9)], s[int(100 * 0.99)], s[-1])
    assert tuple(stats.token_stats(spark.createDataFrame([], "n int"), "n").first()) == (0, 0, 0, 0, 0)


def test_greedy_is_first_wins_not_components(spark):
    rng = random.Random(2)
    for n, m in ((3, 2), (40, 60), (60, 30)):
        edges = {(0, 1), (1, 2)} if n == 3 else {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
        kept: list[int] = []
        for v in range(n):
            if not any((k, v) in edges for k in kept):
                kept.append(v)
        e = spark.createDataFrame(list(edges), "lo long, hi long")
        assert sorted(r.id for r in dedup.greedy_first_wins(spark.range(n), e, "id").collect()) == kept


def test_minhash_families(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words[:-1], "x"]), "other text entirely of six words", ""]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for family in ("compat", "independent"):
        sig = [r.s for r in d.select("id", minhash.signature(F.col("t"), family).alias("s")).orderBy("id").collect()]
        assert all(len(s) == 64 for s in sig) and sig[3] == [0] * 64
        assert sum(a == b for a, b in zip(sig[0], sig[1])) > 32 and sum(a == b for a, b in zip(sig[0], sig[2])) < 16


def _examples(spark, texts):
    rows = [(i, [("user", q), ("assistant", a)], n) for i, (q, a, n) in enumerate(texts)]
    return spark.createDataFrame(rows, "rank long, messages array<struct<role:string,content:string>>, token_count int")


def test_hot_bands_lose_no_pair(spark, monkeypatch):
    import random

    rng = random.Random(3)
    base = [rng.randrange(1000) for _ in range(minhash.SLOTS)]
    rows = []
    for i in range(60):
        sig = list(base)
        for k in rng.sample(range(8 if i % 2 else 0, minhash.SLOTS), rng.randrange(1, 7)):
            sig[k] = rng.randrange(1000)
        rows.append((i, sig))
    d = spark.createDataFrame(rows, "id long, sig array<long>")
    once = {tuple(r) for r in minhash.similar_pairs(d, "id").collect()}
    bands = lambda s: [tuple(s[b * 8 : b * 8 + 8]) for b in range(8)]
    want = {(a, b) for a, x in rows for b, y in rows if a < b and any(p == q for p, q in zip(bands(x), bands(y))) and sum(p == q for p, q in zip(x, y)) >= 0.85 * 64}
    assert {r[:2] for r in once} == want and len(want) > 100
    monkeypatch.setattr(minhash, "HOT_BAND", 2)
    assert {tuple(r) for r in minhash.similar_pairs(d, "id").collect()} == once


def test_accept_reasons_and_stop(spark):
    bench = spark.createDataFrame([("write a function that adds two numbers together now",)], "text string")
    c = _examples(spark, [("Write a function that adds two numbers together now!", "x", 5), ("question one two three four", "answer", 5), ("Question ONE two three four", "answer", 5), ("long", "long", 500), ("another question of some words", "yes", 5), ("never looked at by the scan", "no", 5)])
    got = {r["rank"]: r.reason for r in accept.accept(c, bench, "text", 100, 2).collect()}
    assert got == {0: "benchmark_overlap", 1: None, 2: "duplicate", 3: "too_long", 4: None}
    assert accept.accept(c, bench, "text", 100, 0).count() == 0


def test_gates(spark):
    rows = [("baseline", "benchmarks", "humaneval_plus_pass_at_1", 0.2), ("baseline", "benchmarks", "mbpp_plus_pass_at_1", 0.3), ("candidate", "", "humaneval_plus_pass_at_1", 0.22), ("candidate", "benchmarks", "mbpp_plus_pass_at_1", 0.31),
            ("baseline", "repo", "file_recall_at_3", 0.1), ("candidate", "repo", "file_recall_at_3", 0.2), ("baseline", "repo", "patch_apply_rate", 0.1), ("candidate", "repo", "patch_apply_rate", 0.1)]
    d = spark.createDataFrame(rows, "report string, section string, metric string, value double")
    first = {r.check_name: r.passed for r in gates.compare(d, "stage1").collect()}
    assert first["core_average_gain_at_least_1pp"] and not first["finite_validation_loss"] and not first["all"]
    assert {r.check_name: r.passed for r in gates.compare(d, "stage2").collect()}["all"]
    p = spark.createDataFrame([("a", 1, "noise"), ("a", 2, 'R:{"length": 5, "success": true, "headroom_fraction": 0.2}'), ("a", 3, "after"), ("b", 1, "boom")], "probe string, line_no int, line string")
    got = gates.probe_results(p, "R:")
    assert {r.probe: (r.length, r.success) for r in got.collect()} == {"a": (5, True), "b": (None, False)}
    assert gates.largest_passing(got).first()[0] == 5
    assert gates.last_checkpoint(spark.createDataFrame([("o/checkpoint-9",), ("o/checkpoint-10",), ("o/checkpoint-x",)], "path string")).first()[0] == "o/checkpoint-10"
    assert gates.resolve_length(10, 8, 4) == (8, True)
    with pytest.raises(ValueError):
        gates.resolve_length(10, 2, 4)


def test_repository_tasks(spark):
    patch = "diff --git a/src/calc.py b/src/calc.py\n--- a/src/calc.py\n+++ b/src/calc.py\n@@ -1 +1 @@ def add(a, b):\n-x\n+y\n"
    t = spark.createDataFrame([("i1", "swesmith/owner__repo.abcdef1", patch, "Bug", ["tests/test_calc.py::t"], None, "img"), ("i2", "bad", patch, None, None, None, None)], "instance_id string, repo string, patch string, problem_statement string, fail_to_pass array<string>, pass_to_pass array<string>, image_name string")
    files = [("src/calc.py", "import helpers\n"), ("src/helpers.py", "h = 1\n"), ("tests/test_calc.py", "t\n"), ("a/../b.py", "no")]
    f = spark.createDataFrame([("owner/repo", "abcdef1", p, c) for p, c in files], "repo string, commit string, path string, content string")
    got = {r.source_id: r for r in repo_context.build(t, f, "python").collect()}
    assert got["i1"].skip is None and "### FILE: src/calc.py" in got["i1"].messages[1].content and got["i1"].repo_id == "owner/repo"
    assert "### FILE: tests/test_calc.py" in got["i1"].messages[1].content
    assert [r.skip for k, r in got.items() if k != "i1"] == ["unsafe repository"]


def test_arrange_is_monotone(spark):
    d = spark.createDataFrame([(["r"], [str(i) for i in range(10)])], "r array<string>, o array<string>")
    at = [d.select(F.array_position(repo_context.arrange(F.col("r"), F.col("o"), F.lit(b)), "r")).first()[0] for b in range(5)]
    assert at == sorted(at) and at[0] == 2 and at[4] == 10


def test_files_and_bundles(spark, tmp_path):
    e = spark.createDataFrame([("1", "s"), ("2", "s")], "id string, source string")
    assert writers.write_examples(e, f"{tmp_path}/x/out") == 2
    assert readers.read_examples(spark, f"{tmp_path}/x/out").count() == 2
    with pytest.raises(RuntimeError):
        writers.write_if_complete(e, 3, f"{tmp_path}/x/none", {}, f"{tmp_path}/x/m.json")
    assert '"complete": false' in (tmp_path / "x/m.json").read_text() and not (tmp_path / "x/none").exists()
    assert writers.write_if_complete(e, 2, f"{tmp_path}/x/all", {"k": 1}, f"{tmp_path}/x/m.json") == 2
    assert readers.read_examples(spark, f"{tmp_path}/x/all").count() == 2 and not (tmp_path / "x/all.incomplete").exists() and '"complete": true' in (tmp_path / "x/m.json").read_text()
    writers.write_settings({"b": 1, "a": {"c": [1]}}, f"{tmp_path}/x/s.yaml")
    assert "c" in (tmp_path / "x/s.yaml").read_text()
    for bad in ("/", "/tmp", "/a/$X/b"):
        with pytest.raises(ValueError):
            writers.guard(bad)
    (tmp_path / "a").mkdir()
    (tmp_path / "a/f.txt").write_text("hello")
    (tmp_path / "a/g.bin").write_bytes(b"a\x00b")
    assert [tuple(r) for r in readers.read_files(spark, f"{tmp_path}/a", 100).collect()] == [("f.txt", "hello")]
    b = writers.bundle(spark, [f"{tmp_path}/a/f.txt"])
    assert len(b.first().sha256) == 64 and writers.bundle_differences(b, b).count() == 0
    assert writers.bundle_differences(b, b.withColumn("sha256", F.lit("x"))).count() == 1
    assert readers.merge_settings({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_reading_by_language_and_with_rules(spark, tmp_path):
    for folder in ("c++", "python"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "a.jsonl").write_text('{"commit": "%s"}\n\n' % folder)
    got = readers.read_by_language(spark, str(tmp_path), ["cpp", "python"], readers.COMMIT, readers.COMMIT_DIRS)
    assert {(r["commit"], r["language"]) for r in got.collect()} == {("c++", "cpp"), ("python", "python")}
    with pytest.raises(ValueError):
        readers.read_by_language(spark, str(tmp_path), [], readers.COMMIT, {})
    good = '{"id": "1", "source": "s", "source_id": "1", "split": "train", "token_count": 1, "messages": [{"role": "assistant", "content": "a"}]}'
    (tmp_path / "e.jsonl").write_text(good + "\n\n" + good.replace("train", "dev") + "\n")
    valid, faults = readers.read_valid_examples(spark, f"{tmp_path}/e.jsonl")
    assert valid.count() == 1 and faults.first()["violation"] == "unsupported split"
    spark.createDataFrame([("c", 5)], "commit string, other int").write.parquet(f"{tmp_path}/p.parquet")
    assert readers.read_rows(spark, f"{tmp_path}/p.parquet", readers.COMMIT).first()["old_file"] is None


def test_priority_sample_beyond_a_plain_top_k(spark, monkeypatch):
    d = spark.range(3000).select((F.col("id") % 700).cast("string").alias("k"), "id")
    want = [r.id for r in sampling.priority_sample(d, F.col("k"), 40, tie="id").collect()]
    monkeypatch.setattr(sampling, "TOP_K", 0)
    assert [r.id for r in sampling.priority_sample(d, F.col("k"), 40, tie="id").collect()] == want
    assert sampling.priority_sample(d, F.col("k"), 5000, tie="id").count() == 3000 and sampling.priority_sample(d.where("id < 0"), F.col("k"), 5).count() == 0
    same = spark.range(50).select(F.lit("x").alias("k"))
    assert sampling.priority_sample(same, F.col("k"), 7).count() == 7


def test_redistribution_is_round_by_round():
    import random

    rng = random.Random(1)
    for _ in range(200):
        keys = "abcde"[: rng.randrange(1, 6)]
        wanted, there = ({k: rng.randrange(9) for k in keys} for _ in "ab")
        got = {k: min(wanted[k], there[k]) for k in keys}
        missing = sum(wanted.values()) - sum(got.values())
        while missing and any(there[k] > got[k] for k in keys):  # the definition
            for k in sorted((k for k in keys if there[k] > got[k]), key=lambda k: (got[k] - there[k], k))[:missing]:
                got[k] += 1
                missing -= 1
        assert sampling.redistribute(wanted, there) == got


def test_repository_backfill_fills_a_split_from_its_overflow(spark):
    rows = [(f"{s}{k}{i}", s, k) for s, k, n in (("train", "py", 9), ("train", "go", 1), ("test", "py", 1)) for i in range(n)] + [("x", "dev", "py"), (None, None, None)]
    d = spark.createDataFrame(rows, "id string, split string, language string")
    got = sampling.repo_backfill(d, {"train": 6, "test": 2}, {"py": 0.5, "go": 0.5}, ["id"], F.col("id")).collect()
    by = {(s, k, f): sum(r.split == s and r.language == k and r.filled == f for r in got) for s in ("train", "test") for k in ("py", "go") for f in (True, False)}
    assert by["train", "py", False] == 3 and by["train", "go", False] == 1 and by["train", "py", True] == 2 and by["test", "py", False] == 1 and len(got) == 7
    targets = {"train": {"py": 10}, "validation": {"py": 3}, "test": {"py": 5}}
    assert sampling.repo_candidates(targets, "py") == 125 and sampling.repo_candidates(targets, "go") == 100
    a, b = sampling.limited(d, d, 3, ["id"])
    assert (a.count(), b.count()) == (3, 1) and sampling.limited(d, d, None, ["id"]) == (d, d)


def test_examples_of_dirty_rows(spark):
    rows = spark.createDataFrame([("1", None, None, None, None, "90%", '{"score": 4}'), (None, "x", "y", None, None, None, None)], readers.INSTRUCTION)
    got = mixture.instruction_examples(mixture.with_tier(rows), "eer6_broad", F.col("tier")).collect()
    assert [(r.id, r.quality_tier, r.language) for r in got] == [("eer6_broad:1", "C", "unknown")]
    assert mixture.commit_examples(spark.createDataFrame([], readers.COMMIT)).count() == 0


def test_contracts_name_every_fault(spark):
    sound = ("ok", None, None, True, None, None, None, None, 4096)
    bad = ("bad", True, False, False, 16, 32, 0.1, ["q_proj"], 100)
    got = contracts.setting_faults(spark.createDataFrame([sound, bad], contracts.SETTINGS)).collect()
    assert {r.run for r in got} == {"bad"} and {r.fault for r in got} == {"quantized", "not_16bit", "not_bf16", "adapter_size", "dropout", "missing_projections", "length"}
    m = spark.createDataFrame([("a", True, "true"), ("b", True, "1"), ("c", False, None), ("d", None, "true")], "name string, present boolean, complete string")
    assert {(r.name, r.fault) for r in contracts.manifest_faults(m).collect()} == {("b", "incomplete"), ("c", "missing"), ("d", "missing")}
    schema = "run string, stage string, gate_required boolean, gate_present boolean, gate_stage string, gate_passed boolean, adapter_present boolean, adapter_stage string"
    runs = [("1", "stage2", None, True, "stage1", True, True, "stage1"), ("2", "stage2", None, False, None, None, False, None), ("3", "stage2", False, False, None, None, True, "stage2"), ("4", "publish", None, None, None, None, True, "stage1"), ("5", "stage1", None, None, None, None, None, None)]
    got = {(r.run, r.fault) for r in contracts.lineage_faults(spark.createDataFrame(runs, schema)).collect()}
    assert got == {("2", "gate_missing"), ("2", "adapter_missing"), ("3", "adapter_stage"), ("4", "adapter_stage")}
    b = spark.createDataFrame([("x", "/d/s1.jsonl", "/d/repo.jsonl"), ("y", "/d/$A/s.jsonl", "/e/r.jsonl")], "bundle string, stage1_path string, repo_path string")
    assert {(r.bundle, r.fault) for r in contracts.layout_faults(b).collect()} == {("y", "unresolved"), ("y", "two_directories")}
    files = contracts.layout(b).where("bundle = 'x'")
    assert sorted(r.name for r in files.collect()) == ["repo.jsonl", "repo.manifest.json", "s1.jsonl", "s1.manifest.json"]
    faults = contracts.bundle_faults(b.where("bundle = 'x'"), files.where("name <> 's1.jsonl'"), files.where("name like '%.manifest.json'").withColumn("complete", F.when(F.col("name") == "repo.manifest.json", "yes").otherwise("true")))
    assert {(r.name, r.fault) for r in faults.collect()} == {("s1.jsonl", "missing file"), ("repo.manifest.json", "incomplete manifest")}
    assert contracts.repository_id_faults(spark.createDataFrame([("a/b",), ("a",), ("a/b/c",), (None,)], "r string"), "r").count() == 3
    o = spark.createDataFrame([("p", ["1", "2"]), ("q", ["1"])], "probe string, outputs array<string>")
    assert contracts.output_faults(o, o).count() == 0 and contracts.output_faults(o, o.withColumn("outputs", F.reverse("outputs"))).first()["probe"] == "p"


def test_audits_and_failed_probes(spark):
    m = spark.createDataFrame([("m.q_proj", 2, True), ("m.out_proj", 3, False), ("m.up_proj", 4, False), ("m.visual.x", 5, True)], "name string, numel long, trainable boolean")
    assert [(r.fault, r.names) for r in gates.audit_faults(m).collect()] == [("vision parameters are trainable", ["m.visual.x"])]
    got = {r.fault: r.names for r in gates.audit_faults(m.where("name = 'm.up_proj'")).collect()}
    assert got == {"missing projection families": ["full_attention", "linear_attention"], "nothing is trainable": []}
    lines = [("a", 1, 'R:{"length": 5, "success": true, "headroom_fraction": 0.2}', "out", 5, 1), ("a", 2, "e" * 5000, "err", 5, 1), ("b", 1, "no mark", "out", 7, 0)]
    r = {x.probe: x for x in gates.probe_results(spark.createDataFrame(lines, "probe string, line_no int, line string, stream string, length int, exit_code int"), "R:").collect()}
    assert (r["a"].success, r["a"].length, len(r["a"].error)) == (False, 5, gates.ERROR_TAIL) and (r["b"].length, r["b"].error) == (7, "no mark")
    assert gates.probe_lengths(spark.createDataFrame([(9,), (3,), (9,)], "length int")).first()["lengths"] == [3, 9]


def test_counts_by_window(spark, tmp_path):
    spark.sql("select 'a' as k, timestamp'2024-01-01 00:00:01' as ts union all select 'a', timestamp'2024-01-01 00:00:09' union all select 'b', timestamp'2024-01-01 00:00:11' union all select null, null").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k string, ts timestamp").parquet(f"{tmp_path}/in")
    q = incremental.counts_by_window(s, "k", "ts", "1 minute", "10 seconds").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("windows").collect()) == [("a", 2), ("b", 1)]


def test_a_source_that_is_full_blocks_no_later_row(spark):
    say = lambda t: [("user", t), ("assistant", "done " + t)]
    words = "one two three four five six seven eight nine ten".split()
    texts = {1: " ".join(words), 2: " ".join(words[::-1]), 3: " ".join(w + "x" for w in words)}
    rows = [(1, 0, 5, say(texts[1])), (2, 0, 5, say(texts[2])), (11, 1, 5, say(texts[2])), (12, 1, 5, say(texts[1])), (13, 1, 500, say(texts[3])), (14, 1, 5, None)]
    c = spark.createDataFrame(rows, "rank long, source_no int, token_count int, messages array<struct<role:string,content:string>>")
    bench = spark.createDataFrame([("nothing of the kind",)], "text string")
    got = {r["rank"]: r.reason for r in accept.accept(c, bench, "text", 100, {0: 1, 1: None}).collect()}
    assert got == {1: None, 11: None, 12: "duplicate", 13: "too_long", 14: None}


def test_streaming_dedup(spark, tmp_path):
    spark.sql("select 'A b' as t, timestamp'2024-01-01 00:00:00' as ts union all select 'a  B!', timestamp'2024-01-01 00:00:01' union all select 'c', timestamp'2024-01-01 00:00:02'").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("t string, ts timestamp").parquet(f"{tmp_path}/in")
    q = incremental.exact_dedup(s, "t", "ts", "1 hour").writeStream.format("memory").queryName("dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup").count() == 2
