"""Personal addresses: extraction, redaction by pseudonym, and the gate every writer passes."""

from __future__ import annotations

import hashlib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_lens.functions.scalars import col, hash_email

# The address pattern with the bounds that keep it linear, and what is exempt.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,24}"
VCS_LOCAL_PART = r"(?i)^(git|hg|svn)@"
ROLE_ADDRESSES = ("npm@npmjs.com", "41898282+github-actions[bot]@users.noreply.github.com")
EMAIL_KEY = r'(?i)"[A-Za-z_]*e-?mail[A-Za-z_]*"\s*:'
MAILTO = r"""(?i)mailto:(?!h:[0-9a-f]{32}\b)[^\s"'<>)\]]+"""
REMOVED = "[address removed]"


class LeakError(ValueError):
    """A write was refused; carries the rule and a masked sample."""

    def __init__(self, rule: str, sample: str):
        super().__init__(f"refused by rule {rule}: {sample}")
        self.rule, self.sample = rule, sample


def is_exempt(address: Column) -> Column:
    """Code-host logins and role addresses identify nobody."""
    return address.rlike(VCS_LOCAL_PART) | F.lower(address).isin(*ROLE_ADDRESSES)


def addresses(c: str | Column) -> Column:
    """All addresses of a text, in order; empty for null."""
    return F.coalesce(F.regexp_extract_all(col(c), F.lit(EMAIL), F.lit(0)), F.array().cast("array<string>"))


def personal_addresses(c: str | Column) -> Column:
    return F.filter(addresses(c), lambda x: ~is_exempt(x))


def redact(c: str | Column, salt: str) -> Column:
    """Each personal address replaced by its pseudonym.

    The text is split at the addresses and joined again with their replacements, as a
    pattern can't compute a replacement from its match.
    """
    parts = F.split(col(c), EMAIL, -1)
    pairs = F.zip_with(parts, addresses(c), lambda p, m: F.array(p, F.coalesce(F.when(is_exempt(m), m).otherwise(hash_email(m, salt)), F.lit(""))))
    return F.when(col(c).isNotNull(), F.array_join(F.flatten(pairs), ""))


def scrub(c: str | Column) -> Column:
    """Every address replaced by a fixed text."""
    return F.regexp_replace(col(c), EMAIL, REMOVED.replace("[", r"\[").replace("]", r"\]").replace("\\", ""))


def redact_columns(df: DataFrame, salt: str) -> DataFrame:
    """Redact every text in a DataFrame: strings, and strings in arrays, structs, and keys and values of maps."""

    def deep(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return redact(c, salt)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: deep(x, kind.elementType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*(deep(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
        if isinstance(kind, T.MapType):
            return F.map_from_entries(F.transform(F.map_entries(c), lambda e: F.struct(deep(e["key"], kind.keyType), deep(e["value"], kind.valueType))))
        return c

    return df.select(*(deep(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))


def _pseudonym(address: str, salt: str) -> str:
    if re.match(VCS_LOCAL_PART, address) or address.lower() in ROLE_ADDRESSES:
        return address
    return "h:" + hashlib.sha256(f"{salt}\0{address.strip(' ').lower()}".encode()).hexdigest()[:32]


def redact_value(value, salt: str):
    """Every text and key of a parsed JSON value, redacted."""
    if isinstance(value, str):
        return re.sub(EMAIL, lambda m: _pseudonym(m.group(), salt), value)
    if isinstance(value, list):
        return [redact_value(v, salt) for v in value]
    if isinstance(value, dict):
        return {redact_value(k, salt): redact_value(v, salt) for k, v in value.items()}
    return value


def redact_json(c: str | Column, salt: str, marker: bool = False) -> Column:
    """Redact open JSON in Arrow batches: on the parsed value, as an escape before an address would be taken for part of it.

    The result is compact JSON, with a marker field in an object if asked for; text that is
    no JSON is redacted as text; null stays null.
    """
    hash_email("x", salt)  # checks the salt

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            try:
                value = json.loads(text)
            except (ValueError, RecursionError):
                return redact_value(text, salt)
            clean = redact_value(value, salt)
            if marker and isinstance(clean, dict):
                clean["_addresses_redacted"] = True
            return json.dumps(clean, ensure_ascii=False, separators=(",", ":"))

        return texts.map(one)

    return run(col(c))


def gate_violation(c: str | Column, strict: bool = False) -> Column:
    """Name of the rule a text breaks, else null: a personal address, an unredacted mailto target; strictly also a contact key."""
    text = col(c)
    out = F.when(F.size(personal_addresses(text)) > 0, "address").when(text.rlike(MAILTO), "mailto")
    return out.when(text.rlike(EMAIL_KEY), "key") if strict else out


def gate(df: DataFrame, strict: bool = False) -> DataFrame:
    """The same rows; a task fails on the first that breaks a rule."""
    rule = gate_violation(F.to_json(F.struct(*df.columns)), strict)
    return df.where(F.when(rule.isNotNull(), F.raise_error(F.concat(F.lit("refused by rule "), rule)).cast("boolean")).otherwise(F.lit(True)))


def quarantine(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that don't with the rule they break)."""
    marked = df.withColumn("__rule", gate_violation(F.to_json(F.struct(*df.columns)), strict))
    return marked.where("__rule is null").drop("__rule"), marked.where("__rule is not null").withColumnRenamed("__rule", "rule")


#: Names reserved for documentation and tests.
RESERVED = r"(?i)(^|[@.])(example\.(com|net|org)|example|test|invalid|localhost)$"


def audit_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, address) of every address in the text files below a folder that is neither exempt nor of a reserved domain."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    found = files.select(F.col("_metadata.file_path").alias("path"), F.explode(personal_addresses("value")).alias("address"))
    return found.where(~F.col("address").rlike(RESERVED)).distinct()


def check_text(text: str, strict: bool = True) -> str:
    """Driver-side gate for rendered reports; returns the text or raises with a masked sample."""
    for m in re.finditer(EMAIL, text):
        if not re.match(VCS_LOCAL_PART, m.group()) and m.group().lower() not in ROLE_ADDRESSES:
            raise LeakError("address", mask(text, m.start(), m.end()))
    if m := re.search(MAILTO, text):
        raise LeakError("mailto", mask(text, m.start(), m.end()))
    if strict and (m := re.search(EMAIL_KEY, text)):
        raise LeakError("key", mask(text, m.start(), m.end()))
    return text


def mask(text: str, start: int, end: int, around: int = 60) -> str:
    """The surroundings of a match with the match, as written or JSON-escaped, blotted out."""
    hit = text[start:end]
    sample = text[max(0, start - around) : end + around]
    for form in {hit, json.dumps(hit)[1:-1]}:
        sample = sample.replace(form, "***")
    return re.sub(EMAIL, "***", sample)
