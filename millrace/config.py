"""Task dictionaries: blanks, defaults, control rows, secrets."""

from __future__ import annotations

import datetime as dt
import os
import re
from dataclasses import dataclass, field
from typing import Any

# Spellings of "not given".
BLANKS = {"", "None", "none", "null"}
# The audit columns of a target.
AUDIT_COLUMNS = ("CRTD_BY", "CRTD_DTTM", "UPDT_BY", "UPDT_DTTM")


def blank_to_none(value: Any) -> Any:
    """Every spelling of "not given" becomes None, at any depth."""
    if isinstance(value, str):
        return None if value.strip() in BLANKS else value
    if isinstance(value, dict):
        return {k: blank_to_none(v) for k, v in value.items()}
    if isinstance(value, list):
        return [blank_to_none(v) for v in value]
    return value


def load_task(raw: dict) -> dict:
    """Clean a task dictionary. Delimiters and parameters of checks keep their blanks."""
    task = blank_to_none(raw)
    body, raw_body = task.get("task") or {}, raw.get("task") or {}
    for side in ("source", "target"):
        given = (raw_body.get(side) or {}).get("delimiter")
        if given and given not in BLANKS:
            body[side]["delimiter"] = given
    if raw_body.get("data_quality"):
        body["data_quality"] = [dict(row) for row in raw_body["data_quality"]]
    return task


def as_list(value: str | list | None) -> list[str] | None:
    """A comma list, a Python list or nothing."""
    value = blank_to_none(value)
    if value is None:
        return None
    parts = value if isinstance(value, list) else value.split(",")
    return [p.strip() for p in parts if p and p.strip()] or None


def is_yes(value: Any) -> bool:
    return str(value).strip().upper() in {"Y", "YES", "TRUE", "ACTIVE"}


def fill_date_placeholders(name: str, today: dt.date | None = None) -> str:
    """`sales_%DDMMYYYY%` -> `sales_05032024`: each part inside the percent signs is replaced."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    parts = (("YYYY", f"{today:%Y}"), ("YY", f"{today:%y}"), ("MM", f"{today:%m}"), ("DD", f"{today:%d}"))

    def fill(match: re.Match) -> str:
        text = match.group(1).upper()
        for mark, value in parts:
            text = text.replace(mark, value)
        return text

    return re.sub(r"%([DdMmYy]+)%", fill, name)


def secret(name: str) -> str:
    """A credential from the environment: MILLRACE_SECRET_<NAME>. Never from a task file."""
    key = "MILLRACE_SECRET_" + re.sub(r"\W", "_", name).upper()
    if key not in os.environ:
        raise KeyError(f"set the environment variable {key}")
    return os.environ[key]


@dataclass(frozen=True)
class CheckRow:
    """One row of a task's check list."""

    seq_no: int
    check: str
    params: dict = field(default_factory=dict)
    active: bool = True
    ignore_bad_records: bool = True
    threshold: float | None = None
    type: str = "pre_check"

    @classmethod
    def of(cls, row: dict | CheckRow) -> CheckRow:
        if isinstance(row, CheckRow):
            return row
        threshold = blank_to_none(row.get("threshold_bad_records"))
        return cls(
            seq_no=int(row["seq_no"]),
            check=row["check"].removeprefix("expect_"),
            params=dict(row.get("parameters") or {}),
            active=is_yes(row.get("active", "Y")),
            ignore_bad_records=is_yes(row.get("ignore_bad_records", "Y")),
            threshold=None if threshold is None else float(threshold),
            type=row.get("type", "pre_check"),
        )
