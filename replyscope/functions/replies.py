"""Reply drafting, prompts and the grounding guard as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope import constants as C
from replyscope.functions.text import long_numbers


def fill(template: str, fields: dict[str, Column]) -> Column:
    """Replace the {name} marks of a fixed text by columns."""
    names = "|".join(re.escape(name) for name in fields)
    parts = re.split(rf"\{{({names})\}}", template)
    pieces = [fields[part] if i % 2 else F.lit(part) for i, part in enumerate(parts) if i % 2 or part]
    return F.concat(*pieces)


def bullets(retrieved: Column, empty: str) -> Column:
    """One '- text' line per retrieved reply, or the given text for none."""
    lines = F.array_join(F.transform(retrieved, lambda x: F.concat(F.lit("- "), x["text"])), "\n")
    return F.when(F.size(F.coalesce(retrieved, F.array())) > 0, lines).otherwise(F.lit(empty))


def template_reply(intent: Column) -> Column:
    pairs = [F.lit(value) for item in C.TEMPLATES.items() for value in item]
    return F.coalesce(F.create_map(*pairs)[intent], F.lit(C.TEMPLATES[C.FALLBACK_INTENT]))


def render_prompt(brand: Column, message: Column, intent: Column, retrieved: Column, prev: Column) -> Column:
    """Two chat messages (role, content) that ask for a grounded reply."""
    user = fill(
        C.USER_PROMPT,
        {
            "intent": intent,
            "message": message,
            "prev": F.coalesce(F.nullif(prev, F.lit("")), F.lit("none")),
            "context": bullets(retrieved, C.NO_CONTEXT),
        },
    )
    return F.array(
        F.struct(F.lit("system").alias("role"), fill(C.SYSTEM_PROMPT, {"brand": brand}).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def render_rubric(retrieved: Column, intent: Column, customer: Column, draft: Column) -> Column:
    return fill(
        C.RUBRIC_PROMPT,
        {
            "retrieved": bullets(retrieved, C.NO_HISTORY),
            "intent": F.coalesce(intent, F.lit("")),
            "customer": F.coalesce(customer, F.lit("")),
            "draft": F.coalesce(draft, F.lit("")),
        },
    )


def joined_texts(retrieved: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(retrieved, lambda x: x["text"]), " "), F.lit(""))


def ungrounded_numbers(reply: Column, corpus: Column) -> Column:
    """True if any long number of the reply is missing from the corpus text."""
    return F.exists(long_numbers(reply), lambda number: ~F.contains(corpus, number))
