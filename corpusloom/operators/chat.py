"""Chat-formatted training text and the few-shot classification prompt."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import rules


def _turn(chat_format: Mapping, role: str, message: Column) -> list[Column]:
    """The wrapped message, or nothing when the format has no such role."""
    if role not in chat_format:
        return []
    before, after = chat_format[role]
    return [F.lit(before), message, F.lit(after)]


def user_message(text: Column) -> Column:
    return F.concat(F.lit(f"{rules.INSTRUCTION}\n\nText: "), text)


def chat_text(text: Column, answer: Column, model: str = "llama3.2") -> Column:
    """One conversation as a string; an unknown model gets the generic format."""
    chat_format = rules.CHAT_FORMATS.get(model, rules.CHAT_FORMATS["generic"])
    return F.concat(
        *_turn(chat_format, "system", F.lit(rules.SYSTEM_MESSAGE)),
        *_turn(chat_format, "user", user_message(text)),
        *_turn(chat_format, "assistant", answer),
    )


def classification_prompt(text: Column) -> Column:
    return F.concat(F.lit(rules.PROMPT_BEFORE), text, F.lit(rules.PROMPT_AFTER))
