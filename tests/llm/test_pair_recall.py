"""Recall of broken pairs by kind, on proper answers of the test tables that are broken here.

The refusals are by the author of the grammar, and one rule for cut list entries came from misses seen here.
"""

import random

import pyarrow.parquet as pq

from gristmill.llm import pairs

REFUSALS = [
    "I'm afraid I can't provide this.", "We are not able to answer that question.", "Apologies, but I must refuse this request.", "I won't be able to write that for you.", "Leider kann ich dabei nicht helfen.",
    "Das darf ich nicht beantworten.", "Désolé, je ne peux pas vous aider avec cela.", "Je dois refuser cette demande.", "Lo lamento, no puedo responder a esa pregunta.", "Debo rechazar esta solicitud.",
    "Answering this is beyond my scope.", "This task has to be declined.", "I do not feel comfortable and will not continue with this.",
]


def _proper():
    out = []
    for r in pq.read_table("/root/testdata/sf0.01/normalized_examples.parquet", columns=["messages"]).to_pylist():
        m = r["messages"] or []
        if m and m[-1]["role"] == "assistant" and pairs.defect([(x["role"], x["content"]) for x in m]) is None:
            q = next((x["content"] for x in reversed(m) if x["role"] == "user"), None)
            if q and m[-1]["content"]:
                out.append((q, m[-1]["content"]))
    return out


def test_recall_by_kind_on_answers_that_were_broken():
    rng = random.Random(11)
    proper = _proper()
    prose = [(q, a) for q, a in proper if "```" not in a and not a.startswith(("---", "diff")) and len(a) > 150]
    by_language = {}
    for q, a in prose:
        by_language.setdefault(pairs.human_language(pairs.prose(q))[0], []).append((q, a))

    def cut(q, a):
        at = rng.randrange(len(a) * 3 // 10, len(a) * 8 // 10)
        while at < len(a) - 1 and not (a[at - 1].isalpha() and a[at].isalpha()):
            at += 1
        return q, a[:at]

    def echoed(q, a):
        words = q.split(" ")
        words[rng.randrange(len(words))] = "other"
        return q, rng.choice(["", "You asked: ", "> "]) + " ".join(words)

    def foreign(q, a):
        own = pairs.human_language(pairs.prose(q))[0]
        return q, rng.choice(by_language[rng.choice([k for k in by_language if k not in (None, own)])])[1]

    breaks = {
        "truncated": lambda: cut(*rng.choice([x for x in proper if len(x[1]) > 60])), "empty": lambda: (rng.choice(proper)[0], rng.choice(["", " \n", "```python\n```", "---", "***", "<div></div>", "​" * 300, "Answer:", "=" * 500])),
        "echo": lambda: echoed(*rng.choice(proper)), "refusal": lambda: (rng.choice(proper)[0], rng.choice(REFUSALS) + rng.choice(["", " " + rng.choice(["Please ask someone else instead.", "These are the rules of this service, and they hold for all. " * 30])])),
        "wrong_language": lambda: foreign(*rng.choice([x for x in prose if pairs.human_language(pairs.prose(x[0]))[0] in by_language])),
    }
    recall = {}
    for kind, make in breaks.items():
        made = [make() for _ in range(300)]
        said = [pairs.defect([("user", q), ("assistant", a)]) for q, a in made]
        recall[kind] = sum(x == kind for x in said) / len(said)
    print(recall)
    assert all(r >= 0.95 for r in recall.values()), recall
