"""Options of reads, writes and column ciphers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

UNIT_SEPARATOR = "\x1e"
SYMBOL_SEPARATOR = "␞"

# Separators that are normalised to the record separator on landing.
REPLACED_SEPARATORS = ("|^|", ",|'", '","')

# Codec name to file extension.
CODEC_EXTENSIONS: Mapping[str, str] = {
    "gzip": ".gz",
    "gz": ".gz",
    "zstd": ".zstd",
    "bzip2": ".bz2",
    "bz2": ".bz2",
    "zip": ".zip",
    "snappy": ".snappy",
}

CIPHER_TYPES = ("imsi", "mdn", "enb", "svrcd")


def unescape_separator(text: str | None) -> str | None:
    r"""``\036`` or ``\u001e`` written out in a configuration, as the character."""
    if text is None:
        return None
    return text.encode("latin-1", "backslashreplace").decode("unicode_escape")


def normalise_separator(text: str) -> str:
    """Known multi-character separators become the record separator; others stay."""
    plain = unescape_separator(text)
    return UNIT_SEPARATOR if plain in REPLACED_SEPARATORS else plain


@dataclass(frozen=True)
class ReadSpec:
    """How files of one source are read.

    ``quote=""`` takes quotes as they are. ``multi_line`` allows line breaks inside
    quotes, at the price of one task per file.
    """

    format: str = "csv"
    sep: str = UNIT_SEPARATOR
    encoding: str = "UTF-8"
    header: bool = False
    quote: str = '"'
    schema: str | Mapping | None = None
    multi_line: bool = False


@dataclass(frozen=True)
class WriteSpec:
    """How a result is written; ``files`` sets the number of files, ``merge`` makes as few as hold it."""

    format: str = "parquet"
    compression: str | None = None
    sep: str = UNIT_SEPARATOR
    header: bool = False
    merge: bool = False
    file_name: str | None = None
    partition_by: Sequence[str] = ()
    escape: str | None = None
    files: int | None = None

    @property
    def spark_format(self) -> str:
        return "csv" if self.format == "dat" else self.format

    @property
    def codec(self) -> str:
        if self.compression:
            return {"gz": "gzip", "bz2": "bzip2"}.get(self.compression, self.compression)
        return "zstd" if self.spark_format in ("parquet", "orc") else "none"


@dataclass(frozen=True)
class CryptoRule:
    """One cipher type and the 1-based column positions it applies to."""

    type: str
    col_pos: Sequence[int]

    def __post_init__(self) -> None:
        if self.type not in CIPHER_TYPES:
            raise ValueError(f"unknown cipher type {self.type!r}")
        if any(pos < 1 for pos in self.col_pos):
            raise ValueError("column positions start at 1")


@dataclass(frozen=True)
class CipherKeys:
    """Keys per cipher type. The text of the object never shows them."""

    keys: Mapping[str, str] = field(repr=False)

    def __post_init__(self) -> None:
        for kind, key in self.keys.items():
            if kind not in CIPHER_TYPES:
                raise ValueError(f"unknown cipher type {kind!r}")
            if len(key.encode()) != 16:
                raise ValueError(f"the key for {kind!r} must have 16 bytes")

    @classmethod
    def load(cls, provider: Callable[[str], str], kinds: Sequence[str] = CIPHER_TYPES) -> CipherKeys:
        """Ask a caller's secret provider for each key."""
        return cls({kind: provider(kind) for kind in kinds})

    def __getitem__(self, kind: str) -> str:
        return self.keys[kind]


@dataclass(frozen=True)
class CryptoRules:
    """Rules for one source: encryption rules, decryption rules and the raw copy option."""

    encryption: Sequence[CryptoRule] = ()
    decryption: Sequence[CryptoRule] = ()
    already_encrypted: bool = False
    store_raw_and_crypto: bool = False

    @classmethod
    def parse(cls, spec: Mapping) -> CryptoRules:
        rules = spec.get("rules", {})

        def build(name: str) -> tuple[CryptoRule, ...]:
            return tuple(CryptoRule(r["type"], tuple(r["col_pos"])) for r in rules.get(name, ()))

        return cls(
            build("encryption"),
            build("decryption"),
            bool(spec.get("is_encrypted", False)),
            bool(spec.get("store_raw_and_crypto", False)),
        )
