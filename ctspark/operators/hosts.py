"""P7/P8 host normalisation and registered domain (eTLD+1), P11-P13 name helpers.

The public-suffix list is a reference table of ~10k rules.  It is loaded with Spark, its row
count is checked, and it is then broadcast; the eTLD+1 of every host is found with one
broadcast hash lookup per candidate suffix length (the list's longest rule has a handful of
labels), so the mapping rows are never shuffled for this step.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.idna_host import idna_to_ascii_udf
from ..functions.text import col_

# Where a system copy of the public-suffix list is looked for.
#: Rules that are sent to every task (some 100 bytes each); a longer list is left to the session's threshold.
BROADCAST_RULES = 200_000
PSL_PATHS = ("/usr/share/publicsuffix/public_suffix_list.dat", "/usr/share/publicsuffix/effective_tld_names.dat")


def psl_path() -> str | None:
    for p in PSL_PATHS:
        if os.path.exists(p):
            return p
    return None


def load_psl(spark: SparkSession, path: str | None = None, rules: list[str] | None = None) -> DataFrame:
    """Rule table (key, is_exact, is_wild, is_exc, labels).

    ``*.x`` is stored as key x with is_wild, ``!x`` as key x with is_exc.  Non-ASCII rules are
    converted to their ASCII (punycode) form, the form hosts have after normalisation.
    """
    if rules is not None:
        raw = spark.createDataFrame([(r,) for r in rules], "value string")
    elif path is not None:
        raw = spark.read.text(path)
    elif psl_path() is not None:
        # the system copy is on the driver; its lines travel from here, not by path
        with open(psl_path(), encoding="utf-8") as f:
            raw = spark.createDataFrame([(line.rstrip("\n"),) for line in f], "value string")
    else:
        raise FileNotFoundError("no public-suffix list found: give its path, or rules")
    rule = F.split(F.trim(F.col("value")), r"\s+").getItem(0)
    r = raw.select(rule.alias("rule")).filter((F.col("rule") != "") & ~F.col("rule").startswith("//"))
    kind = F.when(F.col("rule").startswith("!"), "exc").when(F.col("rule").startswith("*."), "wild").otherwise("exact")
    body = F.regexp_replace(F.col("rule"), r"^(!|\*\.)", "")
    non_ascii = body.rlike(r"[^\x00-\x7F]")
    key = F.when(non_ascii, idna_to_ascii_udf(F.when(non_ascii, body))).otherwise(F.lower(body))
    return (
        r.select(key.alias("key"), kind.alias("kind"))
        .groupBy("key")
        .agg(
            F.max(F.col("kind") == "exact").alias("is_exact"),
            F.max(F.col("kind") == "wild").alias("is_wild"),
            F.max(F.col("kind") == "exc").alias("is_exc"),
        )
        .withColumn("labels", F.size(F.split("key", r"\.")))
    )


class PublicSuffixTable:
    """A loaded, size-checked rule table and the number of suffix lengths to probe.

    The parsed table is written once to the shared checkpoint folder and read back, so every
    lookup level scans the same files and the broadcast of the table is built once and reused.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rules: list[str] | None = None):
        import hashlib

        from ..session import ensure_checkpoint_dir

        src = path or psl_path() or ""
        stamp = f"{src}:{os.path.getmtime(src) if src and os.path.exists(src) else ''}:{rules}"
        target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ctspark-psl/{hashlib.md5(stamp.encode()).hexdigest()[:12]}"
        load_psl(spark, path, rules).select("key", "is_exact", "is_wild", "is_exc", "labels").coalesce(1).write.mode("overwrite").parquet(target)
        df = spark.read.parquet(target)
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.max("labels").alias("l")).first()
        self.rows = int(stats["n"])
        self.max_labels = int(stats["l"] or 1)
        # of known size; under a session's lower threshold most hosts would meet in one task, that of "com" or of no candidate
        self.df = F.broadcast(df) if self.rows <= BROADCAST_RULES else df


_PSL_CACHE: dict = {}


def default_psl(spark: SparkSession) -> PublicSuffixTable:
    key = (spark.sparkContext.applicationId, psl_path())
    if key not in _PSL_CACHE:
        _PSL_CACHE[key] = PublicSuffixTable(spark)
    return _PSL_CACHE[key]


def normalize_host_ascii(c) -> Column:
    """lower -> drop one leading '*.' -> trim all leading/trailing dots; '' with a hyphen at a label's end (ASCII fast path)."""
    h = F.lower(col_(c))
    h = F.regexp_replace(h, r"^\*\.", "")
    h = F.regexp_replace(h, r"^\.+|\.+\z", "")
    return F.when(h.contains("-") & h.rlike(r"(^|\.)-|-(\.|\z)"), F.lit("")).otherwise(h)


def normalize_host(c) -> Column:
    """Full normalisation; names with a non-ASCII character or ``--`` go through the Arrow-batched IDNA helper."""
    c = col_(c)
    odd = c.rlike(r"[^\x00-\x7F]") | c.contains("--")
    return F.when(odd, idna_to_ascii_udf(F.when(odd, c))).otherwise(normalize_host_ascii(c))


def registered_domain(df: DataFrame, host_col: str, psl: PublicSuffixTable, out: str = "domain") -> DataFrame:
    """Append eTLD+1 of ``host_col`` as ``out`` ('' when the host has none, as on error).

    For labels l1..ln the candidate suffixes are the last j labels, j = 1..L.  A rule ``x`` matches
    candidate x; ``*.x`` matches the candidate one label longer than x; ``!x`` makes x minus its
    first label the suffix and beats every other rule.  Otherwise the longest match wins, and
    with no match the last label is the suffix.
    """
    L = psl.max_labels
    tmp = f"__h_{out}"
    flags = list(range(1, L + 1))
    # staged: labels are split once, candidates built once, the suffix length computed once
    d = df.select("*", F.col(host_col).alias(tmp), F.split(F.col(host_col), r"\.", -1).alias("__labels"))
    labels = F.col("__labels")
    n = F.size(labels)
    d = d.select("*", *[F.when(n >= j, F.array_join(F.slice(labels, -j, j), ".")).alias(f"__c{j}") for j in flags])
    # one broadcast lookup per candidate length; the same relation under an alias per level
    for j in flags:
        d = d.join(psl.df.alias(f"__r{j}"), F.col(f"__c{j}") == F.col(f"__r{j}.key"), "left")
    # every level reads the same columns, so the per-level broadcasts are one reused exchange
    exc_terms = [F.when(F.col(f"__r{j}.is_exc"), F.lit(j - 1)) for j in flags]
    rule_terms = [F.when(F.col(f"__r{j}.is_exact"), F.lit(j)) for j in flags] + [
        F.when(F.col(f"__r{j}.is_wild") & (n >= j + 1), F.lit(j + 1)) for j in flags
    ]

    def greatest(terms):
        if not terms:
            return F.lit(None).cast("int")
        return terms[0] if len(terms) == 1 else F.greatest(*terms)

    suffix_len = F.coalesce(greatest(exc_terms), greatest(rule_terms), F.lit(1))
    d = d.select(*[F.col(c) for c in df.columns], F.col(tmp), labels, suffix_len.alias("__sl"))
    h, sl, n = F.col(tmp), F.col("__sl"), F.size(F.col("__labels"))
    bad = h.isNull() | (h == "") | h.startswith(".") | h.endswith(".") | h.contains("..")
    dom = F.when(~bad & (n > sl), F.array_join(F.slice(F.col("__labels"), -(sl + 1), sl + 1), ".")).otherwise(F.lit(""))
    return d.select(*[F.col(c) for c in df.columns], dom.alias(out))


# ---- P11-P13 -----------------------------------------------------------------------------


def clean_log_name(c) -> Column:
    """Log URL -> file-system friendly name."""
    s = F.regexp_replace(col_(c), r"^https://", "")
    s = F.regexp_replace(s, r"^http://", "")
    s = F.regexp_replace(s, r"[:/]", "_")
    s = F.regexp_replace(s, r"[^A-Za-z0-9._-]", "")
    return F.regexp_replace(s, r"_\z", "")


# Output file extensions by format; unknown formats fall back to .json.
OUTPUT_EXT = {"json": ".json", "jsonl": ".jsonl", "csv": ".csv", "txt": ".txt"}


def output_name(key, fmt, prefix=None) -> Column:
    """Basename of the key, one trailing '.gz' removed (case-sensitive), plus the format's
    extension (format matched case-sensitively); under ``prefix`` when given."""
    trimmed = F.regexp_replace(col_(key), r"/+\z", "")
    base = F.when(trimmed == "", F.lit(".")).otherwise(F.try_element_at(F.split(trimmed, "/"), F.lit(-1)))
    base = F.regexp_replace(base, r"\.gz\z", "")
    f = col_(fmt) if not isinstance(fmt, str) else F.lit(fmt)
    ext = F.coalesce(*[F.when(f == k, F.lit(v)) for k, v in OUTPUT_EXT.items()], F.lit(".json"))
    name = F.concat(base, ext)
    if prefix is None:
        return name
    p = F.regexp_replace(col_(prefix) if not isinstance(prefix, str) else F.lit(prefix), r"/+\z", "")
    return F.when(p == "", name).otherwise(F.concat(p, F.lit("/"), name))


def file_ext(c) -> Column:
    """Lower-case extension of the last path part ('' when none, '.' for a trailing dot)."""
    return F.lower(F.regexp_extract(col_(c), r"(\.[^./]*)\z", 1))


def is_gzip(c) -> Column:
    return file_ext(c) == ".gz"
