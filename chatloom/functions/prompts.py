"""What a model-backed provider is asked: instructions come from files, the rest is built here."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

#: Characters of a step's example text, and triggers named for an objection type.
EXAMPLE_CHARS, TRIGGERS = 220, 5


def instructions(folder: str | Path, name: str) -> str:
    """A prompt file; it must be there."""
    path = Path(folder) / name
    if not path.is_file():
        raise FileNotFoundError(f"no prompt file {path}")
    return path.read_text(encoding="utf-8")


def steps_block(script: dict[str, Any]) -> str:
    """Each step of the script with the start of its first canonical text."""

    def shown(step: dict[str, Any]) -> str:
        example = next(iter(step.get("canonical_texts") or []), "")
        more = "…" if len(example) > EXAMPLE_CHARS else ""
        return f"- step {step['id']}: {step.get('name', '')}\n  e.g. {example[:EXAMPLE_CHARS]}{more}"

    return "\n".join(map(shown, script.get("steps", [])))


def objections_block(script: dict[str, Any]) -> str:
    """Each known objection type with its first triggers; others are left out."""
    from ..domain import OBJECTION_IDS

    known = [o for o in script.get("objection_taxonomy") or [] if o.get("id") in OBJECTION_IDS]
    return "\n".join(f"- {o['id']} ({o.get('name_pt', '')}): {', '.join(map(str, (o.get('triggers') or [])[:TRIGGERS]))}" for o in known) or "(none)"


def question(parts: dict[str, Any]) -> str:
    """Named parts of a request, texts as they are and anything else as JSON."""
    return "\n\n".join(f"{name}:\n{value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)}" for name, value in parts.items())
