"""Small literal relations and settings."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from rosterlake.functions.states import STATE_CODES

#: Names of sources, and seed names of health systems with their domains.
SOURCES = ("NPPES", "CMS", "Site Directory", "Manual Review")
SYSTEMS = (("Ascension", "ascension.org"), ("Mercy", "mercy.net"), ("Baylor Scott & White Health", "bswhealth.com"), ("Ballad Health", "balladhealth.org"), ("Brown University Health", "brownhealth.org"), ("TGH North", "tghnorth.org"))


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(SOURCES)], "source_id long, name string")


def health_systems(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i + 1, n, d) for i, (n, d) in enumerate(SYSTEMS)], "system_id long, name string, primary_domain string")


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(STATE_CODES.items()), "label string, code string")


def _plain(text: str):
    """A value of a settings file: quotes are taken off, [a, b] is a list."""
    text = text.strip()
    if text.startswith("[") and text.endswith("]"):
        return [_plain(x) for x in re.findall(r"'[^']*'|\"[^\"]*\"|[^,]+", text[1:-1]) if x.strip()]
    return text[1:-1] if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"" else text


def read_sections(text: str) -> dict:
    """Settings in sections by indentation: ``key: value``, ``key:`` with deeper lines or ``- item`` lines below it, ``#`` comments."""
    root: dict = {}
    open_at: list[tuple[int, object]] = [(-1, root)]
    for line in text.splitlines():
        bare = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not bare.strip():
            continue
        depth, body = len(bare) - len(bare.lstrip()), bare.strip()
        while open_at[-1][0] >= depth and not (body.startswith("- ") and open_at[-1][0] == depth and isinstance(open_at[-1][1], list)):
            open_at.pop()
        holder = open_at[-1][1]
        if body.startswith("- "):
            if isinstance(holder, list):
                holder.append(_plain(body[2:]))
            continue
        key, sep, value = body.partition(":")
        if not sep or not isinstance(holder, dict):
            continue
        if value.strip():
            holder[key.strip()] = _plain(value)
        else:
            rest = text.split(line, 1)[1].lstrip("\n").splitlines()
            holder[key.strip()] = [] if rest and rest[0].lstrip().startswith("- ") else {}
            open_at.append((depth, holder[key.strip()]))
    return root


def flattened(tree, prefix: str = "") -> dict[str, str]:
    """The leaves of nested settings by their path, joined by dots."""
    items = tree.items() if isinstance(tree, dict) else enumerate(tree)
    out: dict[str, str] = {}
    for k, v in items:
        out |= flattened(v, f"{prefix}{k}.") if isinstance(v, (dict, list)) else {f"{prefix}{k}": v}
    return out


@dataclass
class Settings:
    """Settings of a run; a JSON file or one in sections, then the environment, override the defaults."""

    data_dir: str = "data"
    checksum: str = "warn"
    require_npi: bool = True
    attempts: int = 3
    commit_every: int = 100
    recheck_days: int = 90
    extra: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None, environment: dict | None = None) -> Settings:
        env, given = os.environ if environment is None else environment, {}
        if path and Path(path).exists():
            text = Path(path).read_text(encoding="utf-8-sig")
            try:
                given = json.loads(text)
            except ValueError:
                given = {k: v for k, v in read_sections(text).items()}
        out, known = cls(), {f.name: f for f in fields(cls) if f.name != "extra"}
        if env.get("ROSTERLAKE_DATA_DIR"):
            given["data_dir"] = env["ROSTERLAKE_DATA_DIR"]
        for k, v in given.items():
            if k not in known:
                out.extra[k] = v
                continue
            kind = type(getattr(out, k))
            setattr(out, k, str(v).lower() in ("1", "true", "yes") if kind is bool else kind(v))
        return out
