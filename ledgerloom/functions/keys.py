"""Keys, paths and URLs as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAD_WIDTH = 12

# Key grammar of range archives and of height folders.
# `\z` and `[^\n]` because Java's `$` also matches before a trailing newline.
ARCHIVE_KEY = r"(?i)^(?:([^\n]+)/)?([0-9]+)-([0-9]+)\.tar\.(gz|zst)\z"
BATCH_DIR = r"^batch_([+-]?[0-9]+)_([+-]?[0-9]+)\z"

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed_prefix(prefix: str) -> str:
    """Prefix without one trailing slash."""
    return prefix[:-1] if prefix.endswith("/") else prefix


def padded(height: ColumnLike, width: int = PAD_WIDTH) -> Column:
    """Zero padded height. Longer numbers are kept whole."""
    return F.format_string(f"%0{width}d", col(height))


def height_key(height: ColumnLike, prefix: str = "", width: int = PAD_WIDTH) -> Column:
    """``<prefix>/<padded height>/``."""
    base = trimmed_prefix(prefix)
    return F.concat(F.lit(f"{base}/" if base else ""), padded(height, width), F.lit("/"))


def rel_key(key: ColumnLike, prefix: str) -> Column:
    """Key below a source prefix, cut only on a slash boundary."""
    key = col(key)
    base = trimmed_prefix(prefix.strip().removeprefix("/"))
    if not base:
        return F.regexp_replace(key, "^/", "")
    cut = F.when(key.startswith(f"{base}/"), F.substring(key, len(base) + 2, 2**31 - 1)).otherwise(key)
    return F.when(key == base, "").otherwise(F.regexp_replace(cut, "^/", ""))


def below(path: ColumnLike, root: str) -> Column:
    """Part of a listed file path below the folder `root`."""
    folder = re.sub(r"^file:/+", "/", root).rstrip("/") + "/"
    return F.substring_index(col(path), folder, -1)


def dest_key(key: ColumnLike, source_prefix: str, dest_prefix: str) -> Column:
    """Destination key of a copied object."""
    key = col(key)
    target = dest_prefix.strip()
    if not target:
        return key
    source = trimmed_prefix(source_prefix.strip())
    rel = key
    if source:
        rel = F.when(
            key.startswith(f"{source}/"), F.substring(key, len(source) + 2, 2**31 - 1)
        ).otherwise(key)
    target = trimmed_prefix(target)
    return F.when(rel == "", target).otherwise(F.concat(F.lit(f"{target}/"), rel))


def archive_key(first: ColumnLike, last: ColumnLike, prefix: str = "archives", codec: str = "zstd") -> Column:
    """``<prefix>/<first>-<last>.tar.(gz|zst)``."""
    ext = ".tar.zst" if codec == "zstd" else ".tar.gz"
    name = F.concat(col(first).cast("string"), F.lit("-"), col(last).cast("string"), F.lit(ext))
    return F.concat(F.lit(f"{prefix}/"), name) if prefix else name


def range_name(first: ColumnLike, last: ColumnLike) -> Column:
    """``<first>-<last>``."""
    return F.concat_ws("-", col(first).cast("string"), col(last).cast("string"))


def batch_dir(first: ColumnLike, last: ColumnLike) -> Column:
    """``batch_<first>_<last>``."""
    return F.concat_ws("_", F.lit("batch"), col(first).cast("string"), col(last).cast("string"))


def codec_of(key: ColumnLike) -> Column:
    """Codec by suffix; gzip unless the key ends in ``.tar.zst`` in any case."""
    return F.when(F.lower(col(key)).endswith(".tar.zst"), "zstd").otherwise("gzip")


def shard_member(shard_id: ColumnLike) -> Column:
    """File name of a shard."""
    return F.concat(F.lit("shard_"), col(shard_id).cast("string"), F.lit(".json"))


def _digits(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("bigint")


def path_parts(path: ColumnLike, width: int = PAD_WIDTH) -> Column:
    """``struct(parent, height, member)`` of an object path.

    The height folder is the outermost folder whose name is exactly `width` digits. Paths
    without one give a null height.
    """
    path = col(path)
    pattern = rf"^(?:((?s:.*?))/)??([0-9]{{{width}}})/((?s:.+))\z"
    return F.struct(
        F.regexp_extract(path, pattern, 1).alias("parent"),
        _digits(F.regexp_extract(path, pattern, 2)).alias("height"),
        F.regexp_extract(path, pattern, 3).alias("member"),
    )


def height_of(path: ColumnLike, width: int = PAD_WIDTH) -> Column:
    """Height of an object path, null where the path has no height folder."""
    return path_parts(path, width)["height"]


def parse_archives(df: DataFrame, prefix: str = "archives", exact_prefix: bool = True) -> DataFrame:
    """Rows of `df` whose key names a range archive, with ``first, last, ext``.

    With `exact_prefix` the folder of the key must equal `prefix`; an empty prefix then
    means keys at the root.
    """
    part = lambda i: F.regexp_extract("key", ARCHIVE_KEY, i)
    base = trimmed_prefix(prefix)
    if exact_prefix and base:
        df = df.where(F.col("key").startswith(f"{base}/"))
    parsed = (
        df.where(F.col("key").rlike(ARCHIVE_KEY))
        .withColumn("first", _digits(part(2)))
        .withColumn("last", _digits(part(3)))
        .withColumn("ext", F.lower(part(4)))
    )
    if exact_prefix:
        parsed = parsed.where(F.regexp_replace(part(1), r"/\z", "") == base)
    return parsed.where("first >= 0 and last >= first")


def parse_batch_dirs(df: DataFrame, name: str = "name") -> DataFrame:
    """Rows of `df` whose name is ``batch_<first>_<last>``, with ``first, last``."""
    return (
        df.withColumn("first", _digits(F.regexp_extract(name, BATCH_DIR, 1)))
        .withColumn("last", _digits(F.regexp_extract(name, BATCH_DIR, 2)))
        .where("first >= 0 and last >= first")
    )


def block_url(base: str, height: ColumnLike, api_key: str = "") -> Column:
    """``<base>/<height>`` with the key as a query parameter, if any."""
    url = F.concat(F.lit(trimmed_prefix(base.strip()) + "/"), col(height).cast("string"))
    if not api_key:
        return url
    # url_encode leaves `*` and escapes `~`; a query string wants it the other way round.
    quoted = F.replace(F.replace(F.url_encode(F.lit(api_key)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(url, F.lit("?apiKey="), quoted)


def redact_url(url: ColumnLike) -> Column:
    """URL without its query string."""
    return F.substring_index(col(url), "?", 1)


def etag_text(etag: ColumnLike) -> Column:
    """ETag without surrounding quotes."""
    return F.regexp_replace(col(etag), r'^"+|"+\z', "")


def etag_md5(etag: ColumnLike) -> Column:
    """Lower-case MD5 held by a single-part ETag, null for any other ETag."""
    text = etag_text(etag)
    return F.when(text.rlike(r"^[0-9a-fA-F]{32}\z"), F.lower(text))


def etag_kind(etag: ColumnLike) -> Column:
    """``md5`` or ``other``."""
    return F.when(etag_md5(etag).isNotNull(), "md5").otherwise("other")


def unsafe_member(name: ColumnLike) -> Column:
    """Whether an archive member name must be refused: two dots anywhere."""
    return col(name).contains("..")


def member_path(name: ColumnLike) -> Column:
    """Member name as a relative path: one leading ``./``, then one leading slash removed."""
    return F.regexp_replace(F.regexp_replace(col(name), r"^\./", ""), "^/", "")
