"""Cases in which a part of a job was left out."""

from pyspark.sql import functions as F

from gristmill.llm import pairs, residue


def _real(n):
    words = "the cache keeps rows and reads a block before it sorts each index again while callers wait for that store".split()
    return " ".join(words[(i * 7 + i // 5) % len(words)] for i in range(n))


def _buckets(f, of):
    return set(f.bucket[f.at[of] : f.at[of + 1]])


def test_residue_features_reach_every_word():
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(205)]
    f, late = residue.features([" ".join(words)]), residue.features([words[-1]])
    assert list(f.doc) == [0] * 10 and len(_buckets(f, 9) & _buckets(late, 0)) > len(_buckets(f, 0) & _buckets(late, 0))
    many = residue.features(["a b", "ä {x}\n# ü ü ü ü", "12 345", "\U0001f600"])
    assert list(many.doc) == [0, 1, 1, 2, 3] and list(many.line) == [0, 1, 2, 3, 4] and len(many.pages[1]) == 5
    alone = residue.features(["ä {x}\n# ü ü ü ü"])
    assert _buckets(alone, 0) == _buckets(many, 1) and _buckets(alone, 1) == _buckets(many, 2)


def _texts():
    latin = ["Lorem ipsum dolor sit amet consectetur elit sed", "Lorem ipsum elit sed dolor sit amet consectetur"]
    docs = [f"{_real(20 + i)}\n\n{_real(12 + i)}" for i in range(60)] + [f"# Title\n\n{latin[i % 2]} {i}." for i in range(30)]
    docs += [f"# {{{{ name_{i} }}}}\n\n{{{{ name_{i + 1} }}}}" for i in range(30)] + [f"Error {400 + i}: the server broke. Back to start" for i in range(30)]
    return docs + [f"{_real(9)}\n\nIf `x` gets a 404 Not Found, it tries {i} times.\n\n```\n{{{{ name }}}}\n```\n{_real(20)}" for i in range(30)]


def test_residue_in_wording_that_no_pattern_lists():
    model = residue.fit(_texts())
    one = lambda t: residue.judge(model, [t])[0]
    unlisted = "Sit amet dolor consectetur elit sed ipsum dolor sit amet."
    assert residue.weak_label(unlisted)[0] == 0 and one(unlisted) == "filler"
    assert one(f"{_real(200)} {' '.join([unlisted] * 4)}") == "filler"
    assert residue.weak_label("{{Name9}")[0] == 0 and one("# {{Name9}\n\n{{Name9}") == "placeholder"
    assert one(f"{_real(30)}\n\n{_real(200)}") is None and one(f"> Error 404: the server broke.\n{_real(40)}") is None
    assert residue.judge(model, [None, "", " \n", "```\n{{ name }}\n```"]) == [None] * 4 and residue.judge(model, []) == []
    assert residue.weak_label('{"message": "Not Found", "status": 404}')[0] == 3
    assert residue.visible('{"status": 404}') == '{"status": 404}' and "404" not in residue.visible('He said "Error 404" again')


def test_residue_repeats_of_one_word():
    assert residue.repeats("blah " * 40) and not residue.repeats("blah " * 5) and not residue.repeats(_real(200))
    assert residue.labels("blah " * 40)[0] == 2
    long = f"{_real(300)}\nError 404"
    assert residue.labels(long)[0] == -1 and residue.labels("Error 404\nBack")[0] == 3


def test_residue_fit_without_texts_or_labels():
    assert residue.judge(residue.fit([]), ["a b c"]) == [None]
    assert residue.judge(residue.fit(["a b c"] * 5), ["a b c"]) == [None]


def test_residue_sample_counts_a_hot_text_once(spark):
    rows = [(i, "hot text", "q/r", "s") for i in range(300)] + [(i, f"text {i}", None, "s") for i in range(300, 900)] + [(1000, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, repo_id string, source string")
    got = residue.sample(d.withColumn("source", F.concat("source", F.col("doc_id").cast("string"))), 200)
    assert len(got) == len(set(got)) and 120 <= len(got) <= 280
    assert residue.sample(d.limit(0)) == []


def test_residue_validation_by_hosts_and_phrases(spark):
    rows = [(i, t, f"owner{i % 7}/x", None) for i, t in enumerate(_texts() + _texts())]
    v = residue.validation(spark.createDataFrame(rows, "doc_id long, text string, repo_id string, source string")).toPandas()
    own = v[v.held_out == "hosts"]
    assert own[own.label == own.kind].docs.sum() >= 0.95 * own.docs.sum() > 0 and set(v.held_out) <= {"hosts", "hosts and phrases"}


def test_answer_cut_right_after_a_code_block():
    code = "Use this loop to add the values:\n\n```python\nfor x in rows:\n    total += x\n```\n\n"
    assert pairs.breaks_off(code + "Th", "Add the values.") and pairs.breaks_off(code + "It (as", "Add the values.")
    assert not pairs.breaks_off(code + "That's all.", "Add the values.") and not pairs.breaks_off("42", "How many?") and not pairs.breaks_off("O(n log n)", "How fast?")


def test_long_answers_without_content_are_empty():
    assert pairs.is_empty("<div></div>\n" * 60) and pairs.is_empty("​" * 500) and not pairs.is_empty("<p>The lock is held.</p>\n" * 40)


def test_tiling_tries_every_position():
    b = [w for i in range(80) for w in ("x", "y", "z", f"n{i}")] + "x y z end of".split()
    assert pairs.tiled("x y z end of".split(), b) == 5


def test_pushdown_parser_over_the_whole_answer():
    q = "Sort the rows by age."
    for cut in (
        "Do this:\n\n```python\nfor x in rows:\n    total += f(x,\n```\n", "<details>\n<summary>Why</summary>\n\nIt sorts the rows by age first.", "<!-- the rows\n\nare sorted by age first.",
        "It sorts the rows (by age.", "It sorts the rows.\nThen it says \"done and stops.", "Steps to take here:\n\n1. Sort the rows.\n2.",
    ):
        assert pairs.breaks_off(cut, q), cut
    for whole in (
        "a) It sorts the rows.\n\nb) That is all :)\n\nIt works.", "He said \"sort (the rows.\n\nThat is all of it.", "Use `f(x` here, that is all.", "```python\n# it's (open\ns = \"(\"\nt = '''(\n'''\n```\nThat is all of it.",
        "```rust\nfn f<'a>(x: &'a str) { g('(') }\n```", "<p>It sorts the rows.<br>That is all.</p>", "Use <T> or <name> for the type of the rows.", "```text\n(open\n```\nThat is all of it.", "```sql\nselect 1 -- (open\n```",
    ):
        assert not pairs.breaks_off(whole, q), whole


def test_refusals_of_any_length_and_place():
    policy = " ".join(["These rules were made some time ago and they hold for everyone who writes to us."] * 20)
    assert pairs.is_refusal(f"{policy} Therefore I must decline. {policy}", "Sort the rows by age.")
    asked = "Why does the listener drop the signed packet after the gateway restarts?"
    helpful = "I can't run it here. " + "The listener drops the signed packet because the gateway restarts too early. " * 3
    assert not pairs.is_refusal(helpful, asked) and not pairs.is_refusal("You can't pass two keys. The map keeps one.", asked)
    for x in ("Dazu darf ich keine Auskunft geben.", "Je ne peux pas répondre à cela.", "No puedo ayudar con eso.", "This is outside of what I'm allowed to do.", "I am unable to go on.", "This request has to be declined."):
        assert pairs.is_refusal(x, asked), x


def test_tiling_against_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(14))] for _ in "ab")
        used_a, used_b = [False] * len(a), [False] * len(b)

        def stretch(i, j):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                k += 1
            return k

        while True:  # the definition: all longest free common stretches, in order, until none of three words is left
            free = [(stretch(i, j), i, j) for i in range(len(a)) for j in range(len(b))]
            most = max((k for k, _, _ in free), default=0)
            if most < 3:
                break
            for k, i, j in free:
                if k == most and not any(used_a[i : i + k]) and not any(used_b[j : j + k]):
                    used_a[i : i + k] = used_b[j : j + k] = [True] * k
        assert pairs.tiled(a, b) == sum(used_a)


def test_what_a_pattern_needs_is_stated_in_full():
    import pandas as pd

    for text in pd.read_parquet("/root/testdata/sf0.01/documents.parquet").text.dropna():
        for line in residue.visible(text).split("\n"):
            for _, _, pattern, holds in residue._FAMILIES:
                assert not pattern.search(line) or any(x in line.lower() for x in holds), (line, pattern.pattern)
