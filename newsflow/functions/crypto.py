"""Fernet-compatible encryption columns, built from Spark's
native ``aes_encrypt`` / ``sha2`` / ``base64`` so they run in the JVM.

Token layout (public Fernet spec): base64url(0x80 | 8-byte big-endian
seconds | 16-byte IV | AES-128-CBC-PKCS7 ciphertext | HMAC-SHA256 of all
before). ``aes_encrypt(..., 'CBC', 'PKCS')`` already returns IV | ciphertext.
The HMAC is two nested SHA-256 over pads derived on the driver from the key.

The key is a job parameter. It appears as a literal in the query plan, so
keep ``explain`` output of these plans out of logs.
"""

from __future__ import annotations

import base64
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed value: the reference's decryption-failure text ---------------------
INVALID_TOKEN_MESSAGE = "Invalid token encountered during decryption"
# -----------------------------------------------------------------------------

VERSION = b"\x80"
MIN_TOKEN_BYTES = 1 + 8 + 16 + 16 + 32
# Characters outside the alphabet. Each one of it is named: a class of single
# characters is looked up in a table, one of ranges is tried range by range.
STRAY = f"[^{string.ascii_letters}{string.digits}+/=]+"


def split_key(key: str | bytes) -> tuple[bytes, bytes]:
    raw = base64.urlsafe_b64decode(key if isinstance(key, bytes) else key.encode("ascii"))
    if len(raw) != 32:
        raise ValueError("Fernet key must be 32 url-safe base64-encoded bytes")
    return raw[:16], raw[16:]


def hmac_sha256(msg: Column, signing_key: bytes) -> Column:
    """HMAC-SHA256 (RFC 2104) with a driver-side key: H(k^opad | H(k^ipad | m))."""
    k = signing_key.ljust(64, b"\0")
    ipad = bytes(b ^ 0x36 for b in k)
    opad = bytes(b ^ 0x5C for b in k)
    inner = F.unhex(F.sha2(F.concat(F.lit(bytearray(ipad)), msg), 256))
    return F.unhex(F.sha2(F.concat(F.lit(bytearray(opad)), inner), 256))


def _seconds_be(seconds: Column) -> Column:
    return F.unhex(F.lpad(F.hex(seconds.cast("bigint")), 16, "0"))


def _replaced(text: Column, by: dict[str, str]) -> Column:
    """Each character replaced; a search in the bytes for each, while ``translate``
    looks up every character."""
    for old, new in by.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def encrypt_columns(df: DataFrame, cols: list[str], key: str | bytes,
                    seconds: Column | None = None, iv: bytes | None = None) -> DataFrame:
    """Replace each string column by its Fernet token.

    Two projections: the random-IV ciphertext is computed once in the first
    and only referenced by the second (MAC and token must see the same IV).
    ``iv`` fixes the IV (test vectors only).
    """
    signing, enc = split_key(key)
    ts = _seconds_be(seconds if seconds is not None else F.unix_seconds(F.current_timestamp()))
    ek = F.lit(bytearray(enc))
    tmp = {c: f"__body_{i}" for i, c in enumerate(cols)}

    def aes(c):
        data = F.encode(F.col(c), "UTF-8")
        if iv is None:
            # A constant input would be constant-folded into one ciphertext (one
            # IV for every row). This always-true guard is opaque to the
            # optimizer (unlike rand() >= 0, which Catalyst simplifies), so the
            # random IV is drawn per row.
            data = F.when(F.spark_partition_id() >= 0, data)
            return F.aes_encrypt(data, ek, F.lit("CBC"), F.lit("PKCS"))
        return F.aes_encrypt(data, ek, F.lit("CBC"), F.lit("PKCS"), F.lit(bytearray(iv)))

    step1 = df.select("*", *[F.concat(F.lit(bytearray(VERSION)), ts, aes(c)).alias(tmp[c]) for c in cols])
    step1 = step1.drop(*cols)
    tokens = {c: F.when(F.col(tmp[c]).isNotNull(), _replaced(
        F.base64(F.concat(F.col(tmp[c]), hmac_sha256(F.col(tmp[c]), signing))),
        {"\r": "", "\n": "", "+": "-", "/": "_"})) for c in cols}
    out = step1.select("*", *[tokens[c].alias(c) for c in cols]).drop(*tmp.values())
    return out.select(*df.columns)


def decrypt(token: Column, key: str | bytes) -> Column:
    """Token -> text, or the fixed message for any invalid token.

    The decoded token is bound once per row (a lambda variable), so the
    length checks, the MAC and the cipher all read the same evaluated value.
    """
    signing, enc = split_key(key)

    def check(raw: Column) -> Column:
        n = F.octet_length(raw)
        body = F.substring(raw, F.lit(1), n - 32)
        mac = F.substring(raw, n - 31, F.lit(32))
        valid = ((n >= MIN_TOKEN_BYTES) & (((n - MIN_TOKEN_BYTES) % 16) == 0)
                 & (F.substring(raw, 1, 1) == F.lit(bytearray(VERSION)))
                 & (mac == hmac_sha256(body, signing)))
        plain = F.try_aes_decrypt(F.substring(raw, F.lit(10), n - 9 - 32),
                                  F.lit(bytearray(enc)), F.lit("CBC"), F.lit("PKCS"))
        return F.when(valid, F.decode(plain, "UTF-8"))

    # url-safe decoding skips characters outside the alphabet; only a token
    # that does not decode as it is gets cleaned. The version byte makes "g" the
    # first character, so other texts are not decoded at all, nor rewritten.
    plain64 = _replaced(token, {"-": "+", "_": "/"})
    clean = F.regexp_replace(plain64, STRAY, "")
    raw = F.when(token.rlike("^[^A-Za-z0-9+/_-]*g"),
                 F.coalesce(F.try_to_binary(plain64, F.lit("base64")), F.try_to_binary(clean, F.lit("base64"))))
    bound = F.element_at(F.transform(F.array(raw), check), 1)
    return F.coalesce(bound, F.lit(INVALID_TOKEN_MESSAGE))
