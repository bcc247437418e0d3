"""Keyed pseudonyms and encryption as Spark expressions.

Key material lives in one-row frames read through scalar subqueries: it reaches the executors with
the query but is never a literal, so it does not show up in a printed plan.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64  # SHA-256 block size in bytes
_CIPHER_VERSION = r"^vault:v(\d+):"


class MissingKey(ValueError):
    """No usable key. Raised while the plan is built, before anything is written."""


class KeyRing:
    """The keys of one run: an HMAC key and numbered encryption keys.

    A ring without encryption keys can only make pseudonyms; ``can_decrypt=False`` gives a writer
    that encrypts but cannot read back.
    """

    def __init__(
        self,
        spark: SparkSession,
        hmac_key: bytes | None = None,
        enc_keys: dict[int, bytes] | None = None,
        can_decrypt: bool = True,
        can_encrypt: bool = True,
    ) -> None:
        self._spark = spark
        self._hmac_key = hmac_key
        self._enc_keys = dict(enc_keys or {})
        self._can_decrypt = can_decrypt
        self._can_encrypt = can_encrypt
        self._read: dict[int, Column] = {}
        for version, key in self._enc_keys.items():
            if len(key) not in (16, 24, 32):
                raise MissingKey(f"encryption key v{version} must have 16, 24 or 32 bytes")

    def __repr__(self) -> str:
        return f"KeyRing(versions={sorted(self._enc_keys)})"

    @property
    def current_version(self) -> int:
        if not self._enc_keys:
            raise MissingKey("the key ring holds no encryption key")
        return max(self._enc_keys)

    def _one_row(self, **values: bytes) -> DataFrame:
        schema = ", ".join(f"{name} binary" for name in values)
        return self._spark.createDataFrame([tuple(bytearray(v) for v in values.values())], schema)

    @cached_property
    def _pads(self) -> tuple[Column, Column]:
        if not self._hmac_key:
            raise MissingKey("the key ring holds no HMAC key")
        key = self._hmac_key if len(self._hmac_key) <= _BLOCK else hashlib.sha256(self._hmac_key).digest()
        key = key.ljust(_BLOCK, b"\0")
        frame = self._one_row(ipad=bytes(b ^ 0x36 for b in key), opad=bytes(b ^ 0x5C for b in key))
        return frame.select("ipad").scalar(), frame.select("opad").scalar()

    def _enc_key(self, version: int) -> Column:
        if version not in self._enc_keys:
            raise MissingKey(f"encryption key v{version} is not in the key ring")
        if version not in self._read:  # one frame for a key, however often it is named
            self._read[version] = self._one_row(k=self._enc_keys[version]).scalar()
        return self._read[version]

    def pseudonym(self, value: Column) -> Column:
        """HMAC-SHA256 of the text, the same for the same text and key. Null and empty give null."""
        ipad, opad = self._pads
        text = F.nullif(value, F.lit(""))
        inner = F.unhex(F.sha2(F.concat(ipad, F.encode(text, "UTF-8")), 256))
        return F.concat(F.lit("vault:v1:"), F.base64(F.unhex(F.sha2(F.concat(opad, inner), 256))))

    def encrypted(self, value: Column, version: int | None = None) -> Column:
        """AES-GCM ciphertext with its key version in front. Null and empty give null."""
        if not self._can_encrypt:
            raise PermissionError("this key ring may not encrypt")
        version = version or self.current_version
        text = F.nullif(value, F.lit(""))
        sealed = F.base64(F.aes_encrypt(F.encode(text, "UTF-8"), self._enc_key(version), F.lit("GCM")))
        return F.concat(F.lit(f"vault:v{version}:"), sealed)

    def decrypted(self, ciphertext: Column) -> Column:
        """The text behind a ciphertext, by the key version it names; null where no key fits."""
        if not self._can_decrypt:
            raise PermissionError("this key ring may not decrypt")
        if not self._enc_keys:
            raise MissingKey("the key ring holds no encryption key")
        version = key_version(ciphertext)
        sealed = F.unbase64(F.regexp_replace(ciphertext, _CIPHER_VERSION, ""))
        plain = F.lit(None).cast("string")
        for number in sorted(self._enc_keys):
            opened = F.try_aes_decrypt(sealed, self._enc_key(number), F.lit("GCM")).cast("string")
            plain = F.when(version == number, opened).otherwise(plain)
        return plain

    def rotated(self, ciphertext: Column) -> Column:
        """The ciphertext moved to the newest key; one already there is kept."""
        fresh = self.encrypted(self.decrypted(ciphertext))
        return F.when(key_version(ciphertext) == self.current_version, ciphertext).otherwise(fresh)


def key_version(ciphertext: Column) -> Column:
    """The key version a ciphertext names."""
    return F.regexp_extract(ciphertext, _CIPHER_VERSION, 1).try_cast("int")
