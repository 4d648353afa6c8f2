"""Chat and conversation rows as column expressions. The four extraction rules differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHAT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
        T.StructField("images", T.ArrayType(T.StringType())),
    ]
)
CONVERSATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("image_in_tar", T.StringType()),
        T.StructField("conversations", T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))),
    ]
)
#: Python's str.strip() without arguments, for Java's regular expressions.
BLANK = r"[\s\u001c-\u001f\u0085   -     　]+"


def strip(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.regexp_replace(c, f"^{BLANK}", ""), f"{BLANK}\\z", "")


def _of(turns: Column, field: str, *roles: str) -> Column:
    return F.filter(turns, lambda m: m[field].isin(*roles))


def first_response(conversations: Column | None = None, messages: Column | None = None) -> Column:
    """The first gpt turn, else the first assistant message. A gpt turn of null doesn't fall through."""
    out = F.lit(None).cast("string")
    if messages is not None:
        out = F.get(_of(messages, "role", "assistant"), F.lit(0))["content"]
    if conversations is not None:
        own = _of(conversations, "from", "gpt")
        out = F.when(F.size(own) > 0, F.get(own, F.lit(0))["value"]).otherwise(out)
    return out


def first_filled_response(messages: Column) -> Column:
    """The first assistant message that isn't blank, stripped."""
    own = F.filter(messages, lambda m: (m["role"] == "assistant") & (strip(m["content"]) != ""))
    return strip(F.get(own, F.lit(0))["content"])


def last_of(messages: Column, role: str, field: str = "role", value: str = "content") -> Column:
    """The last message of a role, as the preference generators read it."""
    return F.try_element_at(_of(messages, field, role), F.lit(-1))[value]


def second_value(conversations: Column) -> Column:
    """The second turn, whoever speaks, as the statistics read it."""
    return F.get(conversations, F.lit(1))["value"]


def first_user_prompt(messages: Column) -> Column:
    """The first user content that isn't empty; it may be blank once stripped."""
    own = F.filter(messages, lambda m: (m["role"] == "user") & (m["content"] != ""))
    return strip(F.get(own, F.lit(0))["content"])


def remapped_role(role: Column) -> Column:
    return F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)


def as_conversations(messages: Column) -> Column:
    """Messages as conversation turns with their roles mapped."""
    return F.transform(messages, lambda m: F.struct(remapped_role(m["role"]).alias("from"), F.coalesce(m["content"], F.lit("")).alias("value")))


def image_reference(path: Column) -> dict[str, Column]:
    """shard, member and id of "shard/member": split at the first slash; without one the shard is empty."""
    slash = F.locate("/", path)
    member = F.when(slash > 0, F.substr(path, slash + 1)).otherwise(path)
    name = F.regexp_extract(member, r"([^/]*)$", 1)
    stem = F.when(name.rlike(r"^.+\.[^.]*$") & ~name.rlike(r"^\.+[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    return {"shard": F.when(slash > 0, F.substr(path, F.lit(1), slash - 1)).otherwise(""), "image_in_tar": member, "id": stem}


def with_prompt(messages: Column, prompt: Column | str) -> Column:
    """The first user message's content overwritten; unchanged if there is none."""
    p = F.lit(prompt) if isinstance(prompt, str) else prompt
    first = F.array_position(F.transform(messages, lambda m: F.coalesce(m["role"], F.lit(""))), "user")
    return F.transform(messages, lambda m, i: F.when(i + 1 == first, F.struct(m["role"].alias("role"), p.alias("content"))).otherwise(m))


def prompt_from(template: str, task: Column, language: Column) -> Column:
    """A template with {task} and {language} filled in."""
    return F.replace(F.replace(F.lit(template), F.lit("{task}"), task), F.lit("{language}"), language)


def conversation(prompt: Column | str, answer: Column) -> Column:
    """A conversation of one round."""
    p = F.lit(prompt) if isinstance(prompt, str) else prompt
    return F.array(F.struct(F.lit("human").alias("from"), p.alias("value")), F.struct(F.lit("gpt").alias("from"), answer.alias("value")))


def single_round(conversations: Column) -> Column:
    """Exactly two turns, a human one and then a gpt one, whatever their case."""
    who = F.transform(conversations, lambda t: F.lower(F.coalesce(t["from"], F.lit(""))))
    return F.coalesce(who == F.array(F.lit("human"), F.lit("gpt")), F.lit(False))
