"""Settings: what to mask and how (Policy), and where the tables are (PipelineConfig)."""
from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

# Category names, redaction modes, run modes and defaults.
CATEGORIES = ("email", "phone", "ssn", "credit_card", "name", "address",
              "ip_address", "date_of_birth")
DEFAULT_CATEGORIES = ("email", "phone", "ssn", "credit_card", "name", "address")
REDACTION_MODES = ("mask", "hash", "remove")
RUN_MODES = ("triggered", "continuous")
DEFAULT_RETENTION_DAYS = 90
RETENTION_OFF = ("", "0", "none", "never")
TABLE_KINDS = ("spans", "logs", "annotations")
DEFAULT_FIELDS = {
    "spans": ("attributes", "events", "resource.attributes"),
    "logs": ("body", "attributes", "resource.attributes"),
    "annotations": (),
}

class _Each:
    """The step of a path into every item of an array; no key is equal to it."""


EACH = _Each()
_STEP = re.compile(r'\.?(?:"((?:[^"\\]|\\.)*)"|([^.\[\]"]+))|\[\*\]')
_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+", re.ASCII)
_SAFE_MASK_CHARACTERS = frozenset("*#~^=|!&;") | frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def identifier(label: str, value: str) -> str:
    if not isinstance(value, str) or not _IDENTIFIER.fullmatch(value):
        raise ValueError(f"{label} must hold only letters, digits and underscores, not {value!r}")
    return value


def parse_categories(text: str) -> tuple[str, ...]:
    """Read a list such as ``'email','phone'``; an empty text means no masking."""
    text = text.strip()
    if not text:
        return ()
    names = []
    for item in text.split(","):
        item = item.strip()
        if len(item) < 3 or item[0] != "'" or item[-1] != "'":
            raise ValueError(f"category {item!r} must be a single-quoted name")
        names.append(item[1:-1])
    return _known(names)


def _known(names) -> tuple[str, ...]:
    unknown = [n for n in names if n not in CATEGORIES]
    if unknown:
        raise ValueError(f"unknown categories {unknown}; known are {CATEGORIES}")
    return tuple(dict.fromkeys(names))


def parse_retention(value) -> int | None:
    """Days to keep raw rows, or None if nothing is ever deleted."""
    if value is None:
        return None
    text = str(value).strip().lower()
    if text in RETENTION_OFF:
        return None
    if not re.fullmatch(r"[0-9]+", text, re.ASCII) or int(text) == 0:
        raise ValueError(f"retention must be a positive whole number of days, not {value!r}")
    return int(text)


def _matches_nothing(pattern: str) -> bool:
    """Whether a pattern matches the empty text, as far as Python reads the syntax of Spark's patterns."""
    try:
        return re.fullmatch(pattern, "") is not None
    except re.error:
        return False


def path_steps(path: str) -> tuple[str | _Each, ...]:
    """The steps of a path from the root of a document: keys, and ``EACH`` for every item of an array.

    Keys with dots, brackets or quotes stand in double quotes, with a backslash before a quote or backslash.
    """
    steps, at = [], 0
    while not steps or at < len(path):
        step = _STEP.match(path, at)
        if not step or path.startswith(".", at) != (bool(steps) and not path.startswith("[", at)):
            raise ValueError(f"{path!r} is no path such as a.b[*].c; quote keys that hold dots, brackets or quotes")
        quoted, plain = step.groups()
        steps.append(re.sub(r"\\(.)", r"\1", quoted) if quoted is not None else plain if plain is not None else EACH)
        at = step.end()
    return tuple(steps)


@dataclass(frozen=True)
class Policy:
    """What counts as personal data and what replaces it."""

    categories: tuple[str, ...] = DEFAULT_CATEGORIES
    custom_patterns: Mapping[str, str] = field(default_factory=dict)
    mode: str = "mask"
    mask_character: str | None = None
    salt: str | None = None
    allowlisted_keys: tuple[str, ...] = ()
    allowlisted_paths: tuple[str, ...] = ()  # such as user.id, items[*].sku or "a.key with dots".b
    events_as: str = "json"
    model: Callable | None = None  # returns a function from pandas.Series to pandas.Series

    def __post_init__(self):
        object.__setattr__(self, "categories", _known(self.categories))
        object.__setattr__(self, "allowlisted_keys", tuple(self.allowlisted_keys))
        object.__setattr__(self, "allowlisted_paths", tuple(self.allowlisted_paths))
        for path in self.allowlisted_paths:
            path_steps(path)
        for name, pattern in self.custom_patterns.items():
            identifier("custom pattern name", name)
            if not pattern:
                raise ValueError(f"custom pattern {name!r} is empty")
            if _matches_nothing(pattern):
                raise ValueError(f"custom pattern {name!r} matches the empty text, so it would put a token between all characters")
        if self.mode not in REDACTION_MODES:
            raise ValueError(f"mode must be one of {REDACTION_MODES}, not {self.mode!r}")
        if self.mode == "hash" and not self.salt:
            raise ValueError("hash mode needs a secret salt: short values such as phone numbers "
                             "can be found again by trying them all")
        if self.mask_character is not None and self.mask_character not in _SAFE_MASK_CHARACTERS:
            raise ValueError("mask_character must be one of "
                             + "".join(sorted(_SAFE_MASK_CHARACTERS)))
        if self.events_as not in ("json", "cast"):
            raise ValueError("events_as must be 'json' or 'cast'")


@dataclass(frozen=True)
class PipelineConfig:
    """Where raw tables are read and redacted ones written.

    A root is any folder Spark can reach from every executor; schema and prefix name the
    tables in it.
    """

    source_root: str
    source_schema: str
    target_root: str
    target_schema: str
    table_prefix: str
    policy: Policy = field(default_factory=Policy)
    fields: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(DEFAULT_FIELDS))
    retention_days: int | str | None = DEFAULT_RETENTION_DAYS
    mode: str = "triggered"
    trigger_interval: str = "1 minute"
    max_bytes_per_trigger: int | None = 500 * 1024 ** 3  # a large backlog is committed in steps

    def __post_init__(self):
        for label in ("source_schema", "target_schema", "table_prefix"):
            identifier(label, getattr(self, label))
        for label in ("source_root", "target_root"):
            if not getattr(self, label):
                raise ValueError(f"{label} is required")
        if self.mode not in RUN_MODES:
            raise ValueError(f"mode must be one of {RUN_MODES}, not {self.mode!r}")
        if self.max_bytes_per_trigger is not None and not (
                isinstance(self.max_bytes_per_trigger, int) and self.max_bytes_per_trigger > 0):
            raise ValueError("max_bytes_per_trigger must be a positive number of bytes")
        unknown = set(self.fields) - set(TABLE_KINDS)
        if unknown:
            raise ValueError(f"unknown tables in fields: {sorted(unknown)}")
        object.__setattr__(self, "fields", {**DEFAULT_FIELDS, **self.fields})
        object.__setattr__(self, "retention_days", parse_retention(self.retention_days))

    # Table names are {prefix}_otel_{kind}, redacted_{kind} and
    # {prefix}_trace_unified.
    def raw_name(self, kind: str) -> str:
        return f"{self.table_prefix}_otel_{kind}"

    def raw_path(self, kind: str) -> str:
        return f"{self.source_root}/{self.source_schema}/{self.raw_name(kind)}"

    def redacted_name(self, kind: str) -> str:
        return f"redacted_{kind}"

    @property
    def target_path(self) -> str:
        return f"{self.target_root}/{self.target_schema}"

    @property
    def unified_name(self) -> str:
        return f"{self.table_prefix}_trace_unified"
