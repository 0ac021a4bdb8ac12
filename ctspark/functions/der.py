"""Hex-level ASN.1 DER and TLS-record builders as Catalyst expressions.

Used to derive certificate fixtures from the driver tables entirely on the JVM side, and by the
leaf decoder for its big-endian length fields.  All builders work on upper-case hex strings and
convert to BINARY with ``unhex`` at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# DER encodings of the object identifiers and constant pieces we emit.
OID_CN = "0603550403"  # 2.5.4.3 commonName
OID_O = "060355040A"  # 2.5.4.10 organizationName
OID_OU = "060355040B"  # 2.5.4.11 organizationalUnitName
OID_SAN = "0603551D11"  # 2.5.29.17 subjectAltName
ALG_SHA256_RSA = "300D06092A864886F70D01010B0500"  # sha256WithRSAEncryption, NULL params
VERSION_V3 = "A003020102"
ED25519_SPKI = "302A300506032B6570032100" + "00" * 32  # Ed25519 key of 32 zero bytes
EMPTY_SIGNATURE = "030100"  # BIT STRING, no unused bits, no bits


def lit_hex(s: str) -> Column:
    return F.lit(s)


def nbytes(hex_col: Column) -> Column:
    return (F.length(hex_col) / 2).cast("long")


def hex_uint(n: Column, width_bytes: int) -> Column:
    """Fixed-width big-endian unsigned integer as hex."""
    return F.lpad(F.hex(n.cast("long")), 2 * width_bytes, "0")


def der_length(n: Column) -> Column:
    """Minimal DER definite length octets for n content bytes."""
    return (
        F.when(n < 128, F.lpad(F.hex(n), 2, "0"))
        .when(n < 256, F.concat(F.lit("81"), F.lpad(F.hex(n), 2, "0")))
        .when(n < 65536, F.concat(F.lit("82"), F.lpad(F.hex(n), 4, "0")))
        .otherwise(F.concat(F.lit("83"), F.lpad(F.hex(n), 6, "0")))
    )


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times in ``body`` (a one-element transform).

    Nested TLVs reference their content twice (length and bytes); without the binding the
    expression tree would double at every nesting level.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def tlv(tag_hex: str, content_hex: Column) -> Column:
    return _let(F.coalesce(content_hex, F.lit("")), lambda x: F.concat(F.lit(tag_hex), der_length(nbytes(x)), x))


def fixed_tlv(tag_hex: str, *content_hex: str) -> str:
    """``tlv`` of content that is the same in every row, built once with the plan."""
    content = "".join(content_hex)
    n = len(content) // 2
    length = f"{n:02X}" if n < 128 else f"{0x80 + (n.bit_length() + 7) // 8:02X}{n.to_bytes((n.bit_length() + 7) // 8, 'big').hex().upper()}"
    return tag_hex + length + content


def fixed_rdn(oid_hex: str, value: str) -> str:
    return fixed_tlv("31", fixed_tlv("30", oid_hex, fixed_tlv("0C", value.encode().hex().upper())))


# What every certificate of the fixtures has in common.
ISSUER = fixed_tlv("30", fixed_rdn(OID_O, "Fixture CA"), fixed_rdn(OID_CN, "Fixture Root"))
VALIDITY = fixed_tlv("30", *(fixed_tlv("17", t.hex().upper()) for t in (b"240101000000Z", b"340101000000Z")))
ISSUER_CERTIFICATE = fixed_tlv("30", fixed_tlv("30", VERSION_V3, fixed_tlv("02", f"01{1:016X}"), ALG_SHA256_RSA, ISSUER, VALIDITY, ISSUER, ED25519_SPKI), ALG_SHA256_RSA, EMPTY_SIGNATURE)


def fixed_u24(content_hex: str) -> str:
    """``u24`` of content that is the same in every row."""
    return f"{len(content_hex) // 2:06X}{content_hex}"


def utf8_hex(s: Column) -> Column:
    return F.hex(F.encode(s, "UTF-8"))


def rdn(oid_hex: str, value: Column) -> Column:
    """One RelativeDistinguishedName with a UTF8String value; empty when value is null."""
    atv = tlv("30", F.concat(F.lit(oid_hex), tlv("0C", utf8_hex(value))))
    return F.when(value.isNull(), F.lit("")).otherwise(tlv("31", atv))


def name_hex(o: Column, ou: Column, cn: Column) -> Column:
    return tlv("30", F.concat(rdn(OID_O, o), rdn(OID_OU, ou), rdn(OID_CN, cn)))


def san_extensions(sans: Column) -> Column:
    """[3] EXPLICIT Extensions holding one subjectAltName with dNSName entries; empty if no SANs."""
    general_names = F.array_join(F.transform(sans, lambda s: tlv("82", F.hex(F.encode(s, "US-ASCII")))), "")
    ext = tlv("30", F.concat(F.lit(OID_SAN), tlv("04", tlv("30", general_names))))
    return F.when(F.coalesce(F.size(sans), F.lit(0)) <= 0, F.lit("")).otherwise(tlv("A3", tlv("30", ext)))


def certificate_hex(o: Column, ou: Column, cn: Column, sans: Column, serial: Column) -> Column:
    """A minimal unsigned X.509 v3 certificate (hex)."""
    # 9-byte serial: a fixed 0x01 lead byte keeps it positive and minimally encoded.
    serial_hex = tlv("02", F.concat(F.lit("01"), F.lpad(F.hex(serial.cast("long")), 16, "0")))
    tbs = tlv(
        "30",
        F.concat(
            F.lit(VERSION_V3),
            serial_hex,
            F.lit(ALG_SHA256_RSA),
            F.lit(ISSUER),
            F.lit(VALIDITY),
            name_hex(o, ou, cn),
            F.lit(ED25519_SPKI),
            san_extensions(sans),
        ),
    )
    return tlv("30", F.concat(tbs, F.lit(ALG_SHA256_RSA), F.lit(EMPTY_SIGNATURE)))


def u24(hex_col: Column) -> Column:
    """TLS opaque<0..2^24-1> prefix for a hex payload."""
    return _let(hex_col, lambda x: F.concat(hex_uint(nbytes(x), 3), x))


def be_uint(bin_col: Column, pos: int | Column, width: int) -> Column:
    """Big-endian unsigned integer of ``width`` bytes at 1-based ``pos`` of a BINARY column."""
    pos_c = pos if isinstance(pos, Column) else F.lit(pos)
    return F.conv(F.hex(F.substring(bin_col, pos_c, F.lit(width))), 16, 10).cast("long")
