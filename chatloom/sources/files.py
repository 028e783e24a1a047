"""Files: line lists, scripts, JSON and CSV in and out."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import json
import os
import re
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain

def line_list(path: str | Path) -> list[str]:
    """Lines without blanks and comments, each once, in order."""
    lines = (line.strip() for line in Path(path).read_text(encoding="utf-8").splitlines())
    return list(dict.fromkeys(x for x in lines if x and not x.startswith("#")))


def phone_list(path: str | Path) -> list[str]:
    phones = line_list(path)
    bad = [p for p in phones if not re.fullmatch(r"[0-9]{10,15}", p)]
    if bad or not phones:
        raise ValueError(f"not phone numbers: {bad}" if bad else "no phone numbers")
    return phones


def user_date(text: str | None) -> str | None:
    """``dd.mm.yyyy`` or ``yyyy-mm-dd`` as an ISO date; empty means none."""
    if not text or not text.strip():
        return None
    for form in ("%d.%m.%Y", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(text.strip(), form).date().isoformat()
        except ValueError:
            continue
    raise ValueError(f"not a date: {text}")


def iso_ms(day: str) -> int:
    return int(dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def file_hash(path: str | Path, digits: int = 16) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()[:digits]


def names_hash(names: list[str], digits: int = 16) -> str:
    return hashlib.sha256(",".join(sorted(set(names))).encode()).hexdigest()[:digits]


def load_script(path: str | Path, extensions: str | Path | None = None) -> dict[str, Any]:
    """A sales script: all steps and objection types must be there; other parts default to empty."""
    import yaml

    script = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    missing = sorted(set(domain.STEP_IDS) - {str(x.get("id")) for x in script.get("steps") or []})
    unnamed = sorted(set(domain.OBJECTION_IDS) - {x.get("id") for x in script.get("objection_taxonomy") or []})
    if missing or unnamed:
        raise ValueError(f"script lacks steps {missing} and objection types {unnamed}")
    for part, empty in (("services", []), ("price_grid", []), ("additionals", []), ("negotiation_rules", {}), ("promocoes", {})):
        script[part] = script.get(part) or empty
    return with_extensions(script, Path(extensions).read_text(encoding="utf-8") if extensions and Path(extensions).exists() else None)


def with_extensions(script: dict[str, Any], text: str | None) -> dict[str, Any]:
    """A script and what a document adds to it, empty where there is none."""
    import yaml

    return {**script, "extensions": yaml.safe_load(text or "") or {}}


def checked_replies(extensions: dict[str, Any]) -> dict[str, Any]:
    """Script extensions with exactly one reply for each objection type."""
    found = [r["objection_id"] for r in extensions.get("objection_replies") or []]
    if sorted(found) != sorted(domain.OBJECTION_IDS):
        raise ValueError(f"replies for {sorted(found)}, not one for each of {sorted(domain.OBJECTION_IDS)}")
    return extensions


def yaml_text(value: Any) -> str:
    """Key order and letters stay as they are."""
    import yaml

    return yaml.safe_dump(value, allow_unicode=True, sort_keys=False)


def write_yaml(path: str | Path, value: Any) -> None:
    replace_text(path, yaml_text(value))


def configured_date(path: str | Path) -> str | None:
    """``from_date`` of a settings file as an ISO date; none where the file or the value is missing."""
    import yaml

    try:
        found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        return None
    except yaml.YAMLError as e:
        raise ValueError(f"not YAML: {path}") from e
    value = found.get("from_date") if isinstance(found, dict) else None
    return user_date(str(value)) if value else None


def write_configured_date(path: str | Path, day: str | None) -> None:
    write_yaml(path, {"from_date": day or ""})


def tolerant_json(path: str | Path) -> Any:
    """A JSON document, or an empty object where it is missing or broken."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {}


def replace_text(path: str | Path, text: str) -> None:
    """Write a small file whole or not at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{os.getpid()}.part")
    part.write_text(text, encoding="utf-8", newline="")
    os.replace(part, path)


def write_json(path: str | Path, value: Any) -> None:
    replace_text(path, json.dumps(value, ensure_ascii=False, indent=2))


def read_jsonl(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """Typed JSON lines; blank lines are skipped, ``{}`` is a row of nulls; a missing file may mean no rows."""
    if missing_ok and not Path(path).exists():
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A folder of JSON lines, nulls included, written in parallel; with ``order``, its files are in order one after another."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def read_json_map(spark: SparkSession, path: str | Path, key: str, value: str, kind: str = "long") -> DataFrame:
    """A JSON object with whole numbers as keys (strings in the file) as rows ``key, value``."""
    found = tolerant_json(path)
    return spark.createDataFrame([(int(k), v) for k, v in found.items()], f"{key} long, {value} {kind}")


def append_csv(path: str | Path, header: list[str], rows: list[tuple]) -> None:
    """Add rows to a CSV file; the header is written once, when the file is new."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fresh = not path.exists() or not path.stat().st_size
    with path.open("a", encoding="utf-8", newline="") as f:
        writer = csv.writer(f)
        writer.writerows([header, *rows] if fresh else rows)


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """``chat_id, phone, outcome, notes``; bad ids and outcomes are dropped."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True, schema="chat_id string, phone string, outcome string, notes string")
    rows = rows.selectExpr("try_cast(chat_id as bigint) as chat_id", "phone", "outcome", "notes")
    return rows.filter(rows.chat_id.isNotNull() & rows.outcome.isin(*domain.OUTCOMES))
