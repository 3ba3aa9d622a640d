"""Redaction of secrets and personal data by pattern, in one order everywhere. Off unless asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

QUOTE = "['\"]?"
#: Name and pattern; earlier ones are replaced first. Only ASCII classes, so that Java and RE2 agree.
SECRETS = (
    ("API_KEY", rf"(?i)[_0-9a-z]*?key[_0-9a-z]*?\s*[=:]\s*{QUOTE}[._0-9a-z-]+{QUOTE}"),
    ("AWS_ACCESS_KEY", "AKIA[A-Z0-9]{16}"),
    ("AWS_SECRET_KEY", "[0-9A-Za-z+/=]{40}"),
    ("GITHUB_TOKEN", "ghp_[0-9A-Za-z]{36}"),
    ("GENERIC_SECRET", rf"(?i){QUOTE}[._0-9a-z-]*secret[._0-9a-z-]*{QUOTE}\s*[=:]\s*{QUOTE}[._0-9a-z-]+{QUOTE}"),
)
PERSONAL = (
    ("EMAIL_ADDRESS", r"[0-9A-Za-z._%+-]+@[0-9A-Za-z-]+(\.[0-9A-Za-z-]+)+"),
    ("IP_ADDRESS", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"),
    ("CREDIT_CARD", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"),
    ("PHONE_NUMBER", r"\+[0-9][ ().0-9-]{6,}[0-9]"),
)
#: The same matches for an engine that backtracks, in time linear in the text: a match begins where a run of its leading
#: characters begins, or where the last match ended, and what has been read is not read again.
LINEAR = {
    "API_KEY": rf"(?i)(?:(?<![_0-9a-z])|\G)(?>[_0-9a-z]*?key)[_0-9a-z]*+\s*+[=:]\s*+{QUOTE}[._0-9a-z-]++{QUOTE}",
    "GENERIC_SECRET": rf"(?i)(?:['\"]|(?<![._0-9a-z-])|\G)(?>[._0-9a-z-]*?secret)[._0-9a-z-]*+{QUOTE}\s*+[=:]\s*+{QUOTE}[._0-9a-z-]++{QUOTE}",
    "EMAIL_ADDRESS": r"(?:(?<![0-9A-Za-z._%+-])|\G)[0-9A-Za-z._%+-]++@[0-9A-Za-z-]++(?:\.[0-9A-Za-z-]++)++",
}


def redact_secrets(c: Column) -> Column:
    for name, pattern in SECRETS:
        c = F.regexp_replace(c, LINEAR.get(name, pattern), f"[{name}_REDACTED]")
    return c


def redact_personal(c: Column) -> Column:
    for name, pattern in PERSONAL:
        c = F.regexp_replace(c, LINEAR.get(name, pattern), f"[{name}]")
    return c


def redact(c: Column) -> Column:
    return redact_secrets(redact_personal(c))


def _inside(c: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return redact(c)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _inside(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, v: _inside(v, kind.valueType))
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[_inside(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def sanitise(df: DataFrame, enabled: bool = False, columns: list[str] | None = None) -> DataFrame:
    """All text in the given columns, however deep, redacted; as it is unless enabled."""
    if not enabled:
        return df
    return df.select(*[_inside(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if columns is None or f.name in columns else F.col(f"`{f.name}`") for f in df.schema.fields])
