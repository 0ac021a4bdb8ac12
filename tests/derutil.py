"""Pure-Python DER / RFC 6962 builders for tests (independent of the Spark encoder)."""

OID = {"CN": b"\x55\x04\x03", "O": b"\x55\x04\x0a", "OU": b"\x55\x04\x0b", "SAN": b"\x55\x1d\x11"}


def length(n):
    if n < 128:
        return bytes([n])
    b = n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([0x80 | len(b)]) + b


def tlv(tag, body):
    return bytes([tag]) + length(len(body)) + body


def name(attrs, string_tag=0x0C):
    rdns = b"".join(tlv(0x31, tlv(0x30, tlv(0x06, OID[k]) + tlv(string_tag, v.encode()))) for k, v in attrs)
    return tlv(0x30, rdns)


def cert(subject, sans=(), serial=b"\x01", extra_tbs=b"", trailing=b""):
    alg = tlv(0x30, tlv(0x06, bytes.fromhex("2a864886f70d01010b")) + b"\x05\x00")
    validity = tlv(0x30, tlv(0x17, b"240101000000Z") + tlv(0x17, b"340101000000Z"))
    spki = tlv(0x30, tlv(0x30, tlv(0x06, b"\x2b\x65\x70")) + tlv(0x03, b"\x00" + b"\x00" * 32))
    ext = b""
    if sans:
        gn = b"".join(tlv(0x82, s.encode()) for s in sans)
        ext = tlv(0xA3, tlv(0x30, tlv(0x30, tlv(0x06, OID["SAN"]) + tlv(0x04, tlv(0x30, gn)))))
    tbs = tlv(0x30, tlv(0xA0, tlv(0x02, b"\x02")) + tlv(0x02, serial) + alg + name([("CN", "Issuer")]) + validity + name(subject) + spki + ext + extra_tbs)
    return tlv(0x30, tbs + alg + tlv(0x03, b"\x00")) + trailing


def u24(b):
    return len(b).to_bytes(3, "big") + b


def x509_leaf(der, ts=1505736747404):
    return b"\x00\x00" + ts.to_bytes(8, "big") + b"\x00\x00" + u24(der) + b"\x00\x00"


def precert_leaf(tbs, ts=1505736747404, key_hash=b"\xe3" * 32):
    return b"\x00\x00" + ts.to_bytes(8, "big") + b"\x00\x01" + key_hash + u24(tbs) + b"\x00\x00"


def precert_extra(precert, chain=()):
    return u24(precert) + u24(b"".join(u24(c) for c in chain))
