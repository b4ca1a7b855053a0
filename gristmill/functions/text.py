"""Text expressions with the white-space, word and line rules of Python strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space and word characters as Python's ``re`` has them, for Java's.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
LINE_END = "\r\n|[\n\r\\x0b\\x0c\\x1c-\\x1e\\x85\\x{2028}\\x{2029}]"


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once.

    Inside a lambda Catalyst repeats an expression for every element; a bound
    variable is evaluated one time.
    """
    return F.transform(F.array(value), f)[0]


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


def normalize(c: Column) -> Column:
    """Lower case, everything but letters, digits and ``_`` as single blanks."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "))


def words(c: Column) -> Column:
    """Words of a normalized text; no words give an empty array."""
    return let(normalize(c), lambda n: F.when(n == "", F.array().cast("array<string>")).otherwise(F.split(n, " ")))


def shingles(c: Column, width: int = 5) -> Column:
    """Distinct runs of ``width`` words; a shorter text is one run, an empty one has none."""

    def runs(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.array_join(F.slice(w, i, width), " "))
        return F.when(F.size(w) == 0, w).when(F.size(w) < width, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(every))

    return let(words(c), runs)


def lines(c: Column) -> Column:
    """Lines, without one empty line at the end."""
    return let(F.split(c, LINE_END), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def fenced_code(c: Column) -> Column:
    """Longest fenced block (the first of equals), stripped; without a block the stripped text."""
    bodies = F.regexp_extract_all(c, F.lit(r"(?s)```(?:[A-Za-z0-9_+.#-]+)?\s*\n(.*?)```"), 1)
    ranked = F.transform(bodies, lambda b, i: F.struct(F.length(b).alias("n"), (-i).alias("at"), b.alias("b")))
    return strip(F.coalesce(F.array_max(ranked)["b"], c))


def ranked_values(c: Column) -> Column:
    """Values of a ranked list: bullets, numbers, blanks and quote marks off, empty lines out."""
    bare = F.transform(lines(c), lambda x: F.regexp_replace(strip(F.regexp_replace(x, rf"\A{SPACE}*(?:[-*]|\d+[.)]){SPACE}*", "")), r"\A[`']+|[`']+\z", ""))
    return F.filter(bare, lambda x: x != "")


def token_count(c: Column) -> Column:
    """Default tokenizer: words parted by white space."""
    s = strip(c)
    return F.when(s == "", 0).otherwise(F.size(F.split(s, f"{SPACE}+")))


def truncate_tokens(c: Column, budget: Column) -> Column:
    """At most ``budget`` tokens: whole, or the head, or two thirds head, a mark and one third tail.

    The mark is not counted.  Budgets under 32 keep the head alone.
    """
    left = F.floor(budget * 2 / 3).cast("int")
    right = (budget - left).cast("int")
    join = lambda a: F.array_join(a, " ")

    def cut(t: Column) -> Column:
        # Fixed value: the mark of a cut.
        both = F.concat(join(F.slice(t, F.lit(1), left)), F.lit("\n...<TRUNCATED>...\n"), join(F.slice(t, F.size(t) - right + 1, right)))
        head = join(F.slice(t, F.lit(1), F.greatest(budget, F.lit(0)).cast("int")))
        return F.when(F.size(t) <= budget, c).when(budget < 32, head).otherwise(both)

    return let(F.split(strip(c), f"{SPACE}+"), cut)
