"""Small text formats: JSON in model answers, JSON cells, choices, chats as text."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_fence(text: str) -> str:
    """The inside of a text that is one fenced code block; any other text stripped."""
    block = re.fullmatch(r"\s*```[^\n]*\n(?P<inside>.*?)(\n[ \t]*```[^\n]*)?\s*", text, re.DOTALL)
    return (block["inside"] if block else text).strip()


def json_object(text: str) -> str:
    """The first JSON object that can be read in an answer, whatever stands around it; without one, the text stripped."""
    read = json.JSONDecoder().raw_decode
    for brace in re.finditer(r"\{", text):
        try:
            return text[brace.start() : read(text, brace.start())[1]]
        except ValueError:
            continue
    return text.strip()


def json_cell(value: Any) -> str:
    """A list or record as a CSV cell; spaces after commas and colons, letters as they are."""
    return json.dumps(value, ensure_ascii=False)


def chosen_numbers(text: str, most: int) -> list[int]:
    """Numbers 1 to ``most`` of a comma list, each once, in order."""
    out: dict[int, None] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        if not part.isdecimal() or not 1 <= int(part) <= most:
            raise ValueError(f"not a number from 1 to {most}: {part!r}")
        out[int(part)] = None
    return list(out)


def chat_line(ts_ms: Column, from_me: Column, text: Column) -> Column:
    """A message of a chat written out for people, with its minute in UTC."""
    body = F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), r"(?U)[\s\x1c-\x1f\x85]+$", "")
    when = F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd HH:mm")
    return F.concat(F.lit("["), when, F.lit("] "), F.when(from_me, "ME  ").otherwise("THEM"), F.lit(": "), body)
