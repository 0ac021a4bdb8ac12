"""From certificate lines to the (domain, name, organisation) table.

Plan shape (no shuffle on the main path):
  scan -> strict base64 (Catalyst) -> DER walk (one mapInArrow) -> organisation, filters and
  per-certificate flags on arrays (Catalyst) -> explode names -> eTLD+1 by broadcast lookups.
Per-certificate decisions (organisation filter, self-referential drop, "no usable name" error)
are computed on the certificate row with array functions before the explode, so the exploded
rows never need to be regrouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encoding import B64_SHAPE, ERR_BAD_BASE64, ERR_DATA_EMPTY, ERR_DECODED_EMPTY, strip_crlf
from ..functions.steps import computed
from ..functions.text import go_trim, is_blank
from .hosts import PublicSuffixTable, normalize_host_ascii, registered_domain
from .x509 import extract_cert_fields

# Organisation placeholder that means "no organisation", and status labels.
DCV_ORG = "Domain Control Validated"
ERR_INVALID_ENTRY = "invalid certificate entry"
ERR_NO_MAPPINGS = "no valid domain mappings found in certificate"

MAPPING_COLUMNS = ["domain", "name", "organization", "organizational_unit", "source", "sequence_number"]


def subject_org(df: DataFrame) -> DataFrame:
    """P5: first O and first OU, trimmed; absent -> ''."""
    return df.withColumn("organization", F.coalesce(go_trim(F.try_element_at("organizations", F.lit(1))), F.lit(""))).withColumn(
        "organizational_unit", F.coalesce(go_trim(F.try_element_at("organizational_units", F.lit(1))), F.lit(""))
    )


def validate_entry(seq: Column, data: Column) -> Column:
    """reason or null."""
    return F.when(seq < 0, F.lit("sequence number must be non-negative")).when(
        is_blank(data), F.lit("certificate data cannot be empty")
    )


def validate_mapping(name: Column, org: Column, ou: Column, source: Column, seq: Column) -> Column:
    """first failing rule, or null when the mapping is valid."""
    return (
        F.when(is_blank(name), F.lit("name cannot be empty"))
        .when(is_blank(org) & (F.coalesce(ou, F.lit("")) == ""), F.lit("organization cannot be empty"))
        .when(~F.coalesce(source, F.lit("")).isin("CN", "SAN"), F.lit("source must be either 'CN' or 'SAN'"))
        .when(seq < 0, F.lit("sequence number must be non-negative"))
    )


def validate_certificate(df: DataFrame) -> DataFrame:
    """empty subject / no usable CN or SAN; expiry is not checked."""
    has_name = ~is_blank("common_name") | F.exists(F.coalesce("dns_names", F.array()), lambda s: ~is_blank(s))
    return df.withColumn(
        "certificate_error",
        F.when(F.coalesce("subject_attrs", F.lit(0)) == 0, F.lit("certificate has empty subject")).when(
            ~has_name, F.lit("certificate has no valid names (CN or SAN)")
        ),
    )


def _names_array() -> Column:
    """P6 input: CN (trimmed, when non-blank) then every SAN, as (name, host, source) structs.

    ``host`` is the normalised form (CN trimmed first, SAN raw); the Arrow stage supplies the
    IDNA form for non-ASCII names.
    """
    cn = go_trim("common_name")
    cn_entry = F.when(
        cn != "",
        F.array(F.struct(cn.alias("name"), F.coalesce(F.col("cn_idna"), normalize_host_ascii(cn)).alias("host"), F.lit("CN").alias("source"))),
    ).otherwise(F.array())
    sans = F.coalesce(F.col("dns_names"), F.array().cast("array<string>"))
    idna = F.coalesce(F.col("dns_idna"), F.array().cast("array<string>"))
    san_entries = F.transform(
        sans,
        lambda s, i: F.struct(
            go_trim(s).alias("name"),
            F.coalesce(F.try_element_at(idna, i + 1), normalize_host_ascii(s)).alias("host"),
            F.lit("SAN").alias("source"),
        ),
    )
    return F.concat(cn_entry, san_entries)


def certificates(
    lines: DataFrame,
    seq_col: str = "sequence_number",
    data_col: str = "certificate_data",
    lenient_base64: bool = False,
    partitions: int | None = None,
    keep: tuple = (),
) -> DataFrame:
    """Decode + DER walk + organisation: one row per input entry, arrays intact.

    ``keep`` names extra input columns (e.g. the source file) carried to the outputs.  Give
    ``partitions`` where the input has few, large partitions (unsplittable gzip files, one row
    group): the lines are then dealt out evenly before the certificates are decoded."""
    lines = lines.select(*keep, seq_col, data_col)
    if partitions:
        lines = lines.repartition(partitions)
    # staged projections: each regular expression runs once per row
    data = F.col(data_col)
    d = lines.select(*keep, F.col(seq_col).alias("sequence_number"), data.alias("__data"), is_blank(data).alias("__blank"))
    clean = strip_crlf(F.col("__data"))
    if lenient_base64:
        clean = F.regexp_replace(clean, r"[ \t]", "")
    d = d.select(*keep, "sequence_number", "__data", "__blank", F.when(~F.col("__blank"), clean).alias("__clean"))
    d = d.select(*keep, "sequence_number", "__data", "__blank", "__clean", (F.col("__clean").rlike(B64_SHAPE) & (F.length("__clean") % 4 == 0)).alias("__valid"))
    entry_err = validate_entry(F.col("sequence_number"), F.col("__data"))
    decoded = F.when(F.col("__valid"), F.unbase64("__clean"))
    b64_err = (
        F.when(F.col("__blank"), F.lit(ERR_DATA_EMPTY))
        .when(~F.coalesce(F.col("__valid"), F.lit(False)), F.lit(ERR_BAD_BASE64))
        .when(F.length(decoded) == 0, F.lit(ERR_DECODED_EMPTY))
    )
    d = d.select(
        *keep,
        "sequence_number",
        F.when(entry_err.isNull() & b64_err.isNull(), decoded).alias("der"),
        F.when(entry_err.isNotNull(), F.concat(F.lit(ERR_INVALID_ENTRY + ": "), entry_err)).otherwise(b64_err).alias("decode_error"),
    )
    return subject_org(extract_cert_fields(d, "der", idna=True))


def _with_cert_flags(c: DataFrame) -> DataFrame:
    # staged: the names array is built once, the flags read it
    others = [x for x in c.columns if x != "organization"]
    c = computed(c.select(*others, "organization"), others, organization=F.col("organization"), names=_names_array())
    c = c.select("*", F.coalesce(F.col("org_idna"), normalize_host_ascii(F.col("organization"))).alias("__org_host"))
    org = F.col("organization")
    names = F.col("names")
    n_emit = F.size(F.filter(names, lambda x: x["name"] != ""))
    # nothing emitted but at least one name failed registration.  A blank name has no dot,
    # hence never an eTLD+1, so the error exists exactly when a blank SAN is present.
    no_names_err = (n_emit == 0) & F.exists(names, lambda x: x["name"] == "")
    # organisation that is its own lower-case form and equals one of the normalised names
    org_host = F.col("__org_host")
    self_candidate = (org == F.lower(org)) & F.exists(names, lambda x: x["host"] == org_host)
    return c.select(
        *[x for x in c.columns if x != "__org_host"],
        n_emit.alias("n_names"),
        no_names_err.alias("no_names_error"),
        F.when(self_candidate, org_host).alias("org_host"),
    )


def extract(lines: DataFrame, psl: PublicSuffixTable, keep: tuple = (), observation=None, **kw) -> tuple[DataFrame, DataFrame]:
    """P10: (mappings, entry_status) from (sequence_number, certificate_data) lines.

    entry_status has one row per input entry: stage ok / parse / extract, error, rows emitted,
    and the reason a certificate produced no rows (no_org, dcv, self_referential).
    """
    c = _with_cert_flags(certificates(lines, keep=keep, **kw))
    # eTLD+1 of the organisation host, only for certificates where it could cause a drop
    c = registered_domain(c, "org_host", psl, out="org_domain")
    parse_failed = F.col("decode_error").isNotNull() | F.col("parse_error").isNotNull()
    org = F.col("organization")
    no_org = (org == "") | (org == DCV_ORG)
    self_ref = F.col("org_host").isNotNull() & (F.col("org_domain") != "")
    stage = F.when(parse_failed, F.lit("parse")).when(no_org, F.lit("ok")).when(F.col("no_names_error"), F.lit("extract")).otherwise(F.lit("ok"))
    reason = (
        F.when(parse_failed, F.lit(None))
        .when(org == "", F.lit("no_org"))
        .when(org == DCV_ORG, F.lit("dcv"))
        .when(F.col("no_names_error"), F.lit(None))
        .when(self_ref, F.lit("self_referential"))
    )
    c = c.select("*", stage.alias("stage"), reason.alias("skip_reason"))
    emitted = F.when(F.col("stage").isin("parse", "extract") | F.col("skip_reason").isNotNull(), F.lit(0)).otherwise(F.col("n_names"))
    c = c.select("*", emitted.alias("mappings_emitted"))
    if observation is not None:
        # A1 counters collected as a side effect of writing the mappings: no second pass
        c = c.observe(
            observation,
            F.count(F.lit(1)).alias("total_processed"),
            F.count_if(F.col("stage") == "ok").alias("successful_parsed"),
            F.count_if(F.col("stage") != "ok").alias("errors"),
            F.sum("mappings_emitted").alias("mappings"),
        )

    status_df = c.select(
        *keep,
        "sequence_number",
        "stage",
        F.coalesce(F.col("decode_error"), F.col("parse_error"), F.when(F.col("stage") == "extract", F.lit(ERR_NO_MAPPINGS))).alias("error"),
        "skip_reason",
        F.col("mappings_emitted").cast("long").alias("mappings_emitted"),
    )

    rows = c.filter((F.col("stage") == "ok") & F.col("skip_reason").isNull()).select(
        *keep, "sequence_number", "organization", "organizational_unit", F.posexplode("names").alias("position", "n")
    )
    rows = rows.filter(F.col("n.name") != "").select(
        *keep,
        "sequence_number",
        "organization",
        "organizational_unit",
        "position",
        F.col("n.name").alias("name"),
        F.col("n.host").alias("host"),
        F.col("n.source").alias("source"),
    )
    rows = rows.filter(validate_mapping(F.col("name"), F.col("organization"), F.col("organizational_unit"), F.col("source"), F.col("sequence_number")).isNull())
    mapped = registered_domain(rows, "host", psl, out="domain")
    return mapped.select(*keep, *MAPPING_COLUMNS, "position"), status_df


def extract_mappings(lines: DataFrame, psl: PublicSuffixTable, **kw) -> DataFrame:
    return extract(lines, psl, **kw)[0].drop("position")


def explode_names(certs: DataFrame) -> DataFrame:
    """P6 alone: (sequence_number, position, name, source) for every usable CN/SAN, no de-dup."""
    c = _with_cert_flags(certs)
    return (
        c.select("sequence_number", F.posexplode("names").alias("position", "n"))
        .filter(F.col("n.name") != "")
        .select("sequence_number", "position", F.col("n.name").alias("name"), F.col("n.source").alias("source"))
    )


def format_mapping(df: DataFrame, with_seq: bool = False) -> Column:
    """P9: 'name -> org (SOURCE)' and, for the text sink, ' [seq:N]'."""
    base = F.format_string("%s -> %s (%s)", F.col("name"), F.col("organization"), F.col("source"))
    if with_seq:
        return F.concat(base, F.format_string(" [seq:%d]", F.col("sequence_number")))
    return base


def filter_org(certs: DataFrame) -> DataFrame:
    """F1 on certificate rows (after ``subject_org``): keep certificates with a usable
    organisation; the others count as successes with no rows.  Apply before any explode."""
    org = F.col("organization")
    return certs.filter((org != "") & (org != DCV_ORG))


def drop_self_referential(certs: DataFrame, psl: PublicSuffixTable) -> DataFrame:
    """F2 on certificate rows: drop certificates whose lower-case organisation, normalised like
    a host and with an eTLD+1, equals one of the certificate's normalised CN/SAN hosts."""
    c = registered_domain(_with_cert_flags(certs), "org_host", psl, out="org_domain")
    keep = F.col("org_host").isNull() | (F.col("org_domain") == "")
    return c.filter(keep).drop("names", "n_names", "no_names_error", "org_host", "org_domain")


def no_names_error(certs: DataFrame) -> DataFrame:
    """F6 flag on certificate rows: no mapping would be produced and a name failed registration."""
    return _with_cert_flags(certs).drop("names", "n_names", "org_host")
