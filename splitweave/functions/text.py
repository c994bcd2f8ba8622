"""Names, paths, dates and labels."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from splitweave.functions.keys import as_column

# Name parts that other systems expect.
TABLE_PREFIX = "part_"
SOURCE_PREFIX = "ext_"
IDENTITY_SUFFIX = "_er"
ASSOCIATION_PREFIX = "acx_"
SCHEMA_PREFIX = "ACX_SCHEMA_"
SNAPSHOT_COLUMN = "snapshot_dt"
MARKER_PATH = "metadata/snapshot_dt.txt"
SOURCES_PATH = "metadata/sources"
RECEIVER_RESOURCE = "arn:aws:cleanrooms:"


def snapshot_in_path(path: Column | str) -> Column:
    """The date of a ``snapshot_dt=YYYY-MM-DD`` path part, empty when there is none."""
    return F.regexp_extract(as_column(path), r"snapshot_dt=(\d{4}-\d{2}-\d{2})", 1)


def bucket_in_path(path: Column | str) -> Column:
    """The number of an ``id_bucket=<n>`` directory, NULL when there is none or it is not a number."""
    return F.regexp_extract(as_column(path), r"(?:^|/)id_bucket=([^/]*)(?:/|$)", 1).try_cast("int")


def base_name(table: Column | str) -> Column:
    return F.regexp_replace(as_column(table), "^part_", "")


def source_name(table: Column | str) -> Column:
    return F.concat(F.lit(SOURCE_PREFIX), base_name(table))


def part_name(table: Column | str) -> Column:
    return F.concat(F.lit(TABLE_PREFIX), base_name(table))


def association_name(name: Column | str, prefix: str = ASSOCIATION_PREFIX) -> Column:
    bare = F.regexp_replace(as_column(name), "[-_]assoc$", "")
    return F.when(bare.startswith(prefix), bare).otherwise(F.concat(F.lit(prefix), bare))


def registered_name(directory: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lower(as_column(directory)))


def schema_name(table: Column | str, prefix: str = SCHEMA_PREFIX) -> Column:
    bare = F.replace(F.replace(F.upper(as_column(table)), F.lit("PART_"), F.lit("")), F.lit("_ER"), F.lit(""))
    return F.concat(F.lit(prefix), bare)


def file_safe(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), r"[^\p{L}\p{N}_-]", "_")


def method_label(code: Column | str) -> Column:
    value = F.translate(F.lower(as_column(code)), "_", "-")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("rule-based")).otherwise(value)


def yes_no(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))


def or_na(value: Column | str) -> Column:
    text = as_column(value)
    return F.when(text.isNull() | (text == ""), F.lit("N/A")).otherwise(text)


def account_label(account: Column, labels: Column) -> Column:
    """``1234-5678-9012 (label)`` when the account has a label, otherwise the account unchanged."""
    label = F.element_at(labels, account)
    dashed = F.concat_ws("-", F.substring(account, 1, 4), F.substring(account, 5, 4), account.substr(F.lit(9), F.length(account)))
    return F.when(label.isNull() | (label == ""), account).otherwise(F.concat(dashed, F.lit(" ("), label, F.lit(")")))


def account_list(accounts: Column | str, labels: dict[str, str]) -> Column:
    """All accounts of a list as one text; an empty or missing list gives N/A."""
    ids = as_column(accounts)
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    known = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    joined = F.array_join(F.transform(ids, lambda a: account_label(a, known)), ", ")
    return F.when(F.coalesce(F.size(ids), F.lit(0)) <= 0, F.lit("N/A")).otherwise(joined)


def arn_part(arn: Column | str, position: int) -> Column:
    """Colon-separated part, counted from 0; NULL when there are fewer parts."""
    return F.get(F.split(as_column(arn), ":"), F.lit(position))


def arn_path(arn: Column | str, from_end: int) -> Column:
    """Slash-separated part, 1 = last; NULL when there are fewer parts."""
    parts = F.split(as_column(arn), "/")
    return F.when(F.size(parts) >= from_end, F.element_at(parts, -from_end))


def receiver_account(receiver: Column | str) -> Column:
    """Account of a receiver given as 12 digits or as a resource name; NULL for anything else."""
    text = as_column(receiver)
    return F.when(text.startswith(RECEIVER_RESOURCE), arn_part(text, 4)).when(text.rlike(r"^\d{12}$"), text)


def utc_text(moment: Column | str) -> Column:
    return F.date_format(as_column(moment), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def is_stale(snapshot: Column | str, window_days: int, as_of: date | datetime | str) -> Column:
    """More than ``window_days`` days before ``as_of``; a missing or unreadable date is stale."""
    text = as_column(snapshot)
    day = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date")).cast("timestamp_ntz")
    limit = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_dt_interval(F.lit(window_days))
    return F.coalesce(day < limit, F.lit(True))


def join_path(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *[p.strip("/") for p in parts[1:] if p]])


def normalize_path(path: str) -> str:
    """Resolve ``.`` and ``..`` parts and doubled slashes after the scheme and host."""
    head, rest = re.match(r"^([A-Za-z][\w+.-]*:(?://[^/]*)?)?(.*)$", path).groups()
    kept: list[str] = []
    for part in rest.split("/"):
        if part == "..":
            kept = kept[:-1]
        elif part not in ("", "."):
            kept.append(part)
    return (head or "") + ("/" if rest.startswith("/") else "") + "/".join(kept)
