"""Conversations: building, rendering, checking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.arrays import count_where
from gristmill.functions.hashing import messages_hash
from gristmill.functions.text import SPACE, strip, token_count

# Fixed value: the system prompt of every built example.
SYSTEM_PROMPT = "You are a precise software engineering assistant. Prefer minimal, correct, verifiable changes and preserve existing interfaces."
ROLES = ["system", "user", "assistant", "tool"]
SPLITS = ["train", "validation", "test"]


def make_messages(instruction: Column, response: Column) -> Column:
    """System prompt, stripped instruction and stripped response as ``array<struct<role, content>>``."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", F.lit(SYSTEM_PROMPT)), turn("user", strip(instruction)), turn("assistant", strip(response)))


def role_text(messages: Column, roles: list[str]) -> Column:
    """Contents of the messages of some roles, joined by line feeds; null contents as empty text."""
    picked = F.filter(messages, lambda m: m.role.isin(roles))
    return F.array_join(F.transform(picked, lambda m: F.coalesce(m.content, F.lit(""))), "\n")


def render(messages: Column, end: str = "<|end|>") -> Column:
    """Plain chat template; every turn ends with ``end``, trailing white space off.

    A conversation whose rendering does not end with ``end`` is an error.
    """
    turns = F.transform(messages, lambda m: F.concat(F.lit("<"), m.role, F.lit(">\n"), m.content, F.lit(end)))
    out = F.regexp_replace(F.array_join(turns, "\n"), rf"{SPACE}+\z", "")
    return F.when(out.endswith(end), out).otherwise(F.raise_error(F.lit("the rendering does not end the assistant's turn")))


def message_tokens(messages: Column, tokens=token_count) -> Column:
    """Tokens of the rendered conversation; ``tokens`` is any Column function, by default :func:`token_count`."""
    turns = F.transform(messages, lambda m: F.concat(F.lit("<"), m.role, F.lit(">\n"), F.coalesce(m.content, F.lit(""))))
    return tokens(F.array_join(turns, "\n"))


def violation(messages: Column, **c: Column) -> Column:
    """First rule an example breaks, null where it is valid.  ``c``: id, source, source_id, split, token_count, content_sha256."""
    blank = lambda x: x.isNull() | (x == "")
    return (
        F.when(blank(c["id"]) | blank(c["source"]) | blank(c["source_id"]), "id, source, and source_id are required")
        .when(c["split"].isNull() | ~c["split"].isin(SPLITS), "unsupported split")
        .when(c["token_count"] < 0, "negative token count")
        .when(messages.isNull() | (F.size(messages) <= 0), "no assistant response at the end")
        .when(~F.coalesce(F.try_element_at(messages, F.lit(-1)).role == "assistant", F.lit(False)), "no assistant response at the end")
        .when(~F.forall(messages, lambda m: F.coalesce(m.role.isin(ROLES), F.lit(False))), "invalid role")
        .when(F.exists(messages, lambda m: m.content.isNull()), "content is missing")
        .when(~blank(c["content_sha256"]) & (c["content_sha256"] != messages_hash(messages)), "hash does not match")
    )


def leaks_markers(text: Column) -> Column:
    """Supervised text that holds a user or system turn."""
    return text.contains("<|im_start|>user") | text.contains("<|im_start|>system")


def supervised_counts(labels: Column) -> Column:
    """``struct<supervised, masked>``: labels other than -100, and the rest."""
    s = count_where(labels, lambda x: x != -100)
    return F.struct(s.alias("supervised"), (F.size(labels) - s).alias("masked"))
