"""Column functions of the archive domain; all of them stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.patterns import live, matches

# Texts and the error type that each stands for, in the order of the test.
ERROR_RULES = (
    ("path_error", ("no such file or directory", "file name too long", "path too long")),
    ("permission_error", ("permission denied", "errno 13")),
    ("io_error", ("input/output error", "i/o error", "beyond end of device", "beyond eof")),
    ("hash_error", ("hash", "blake3")),
)
# Status of the retries, health classes, kinds of files.
MAX_ERRORS, SAME_ERRORS, CHECKPOINT, MAX_RETRIES = 5, 3, 10, 50
FS_TYPES = ("d", "f", "l", "s", "p", "b", "c", "u")
STATUSES = ("pending", "success", "failed_retryable", "failed_permanent")
ERROR_TYPES = ("path_error", "io_error", "hash_error", "permission_error", "unknown")
SYNTHETIC_MIME = {"d": "inode/directory", "l": "inode/symlink", "s": "inode/socket", "p": "inode/fifo", "b": "inode/blockdevice", "c": "inode/chardevice"}


def either(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def classify_error(message: Column, exception: Column | None = None, errno: Column | None = None) -> Column:
    """Error type of a message; exception type and errno decide only if no text does."""
    text = F.lower(F.coalesce(message, F.lit("")))
    out = F
    for kind, parts in ERROR_RULES:
        out = out.when(either([text.contains(p) for p in parts]), kind)
    if exception is not None:
        out = out.when(exception == "PermissionError", "permission_error")
        if errno is not None:
            system = exception.isin("IOError", "OSError")
            for number, kind in ((5, "io_error"), (13, "permission_error"), (2, "path_error")):
                out = out.when(system & (errno == number), kind)
    return out.otherwise("unknown")


def failure_status(error_type: Column) -> Column:
    return F.when(error_type == "io_error", "failed_permanent").otherwise("failed_retryable")


def skip_permanently(checks: Column, dmesg: Column) -> Column:
    """Beyond the end by either source, or an I/O error by both."""
    end = F.array_contains(checks, "detected_beyond_eof") | F.array_contains(dmesg, "dmesg:beyond_eof")
    return F.coalesce(end, F.lit(False)) | F.coalesce(F.array_contains(checks, "detected_io_error") & F.array_contains(dmesg, "dmesg:io_error"), F.lit(False))


def checkpoint_check(message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    return F.when(text.contains("beyond eof") | text.contains("beyond end of device"), "detected_beyond_eof").when(text.contains("i/o error") | text.contains("input/output error"), "detected_io_error").when(text.contains("no such file"), "detected_missing_file").when(text.contains("permission denied"), "detected_permission_error")


def rescued_pct(rescued: Column, total: Column) -> Column:
    """Percentage cut (not rounded) to two places; 0 of nothing."""
    hundredths = (rescued * 10000) / F.when(total > 0, total)
    return F.coalesce(F.floor(hundredths).cast("double") / 100, F.lit(0.0))


def health_class(pct: Column) -> Column:
    return F.when(pct.isNull(), "ok").when(pct == 100, "ok").when(pct >= 90, "incomplete").when(pct >= 20, "corrupt").otherwise("failed")


def same_tail(errors: Column, n: int = SAME_ERRORS) -> Column:
    """The last ``n`` errors are there and equal."""
    return F.when(F.size(errors) >= n, F.size(F.array_distinct(F.slice(errors, -n, n))) == 1).otherwise(False)


def excluded(path: Column, patterns: list[str]) -> Column:
    """'pattern_match' where any pattern, or a '#', is in the path; no pattern at all matches only the '#'."""
    return F.when(matches(path, [*live(patterns), "#"]), "pattern_match")


def log2_bucket(n: Column) -> Column:
    """Largest power of two up to a positive integer, exactly."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.length(F.bin(n)) - 1).cast("int"))


def filename(path: Column) -> Column:
    return F.regexp_replace(path, "^.*/", "")


def parent_name(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, "([^/]+)/[^/]*$", 1), F.lit(""))


def grandparent_name(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, "([^/]+)/[^/]+/[^/]*$", 1), F.lit(""))


def by_hash_path(blobid: Column) -> Column:
    return F.concat_ws("/", F.substring(blobid, 1, 2), F.substring(blobid, 3, 2), blobid)


def size_pretty(n: Column) -> Column:
    """Size in the largest binary unit that leaves 10240 at most, halves up."""
    out = F.when(n < 10 * 1024, F.concat(n.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(("kB", "MB", "GB", "TB"), 1):
        value = F.floor((F.floor(n / (1024**power // 2)) + 1) / 2)
        out = out.when((value < 10 * 1024) if unit != "TB" else F.lit(True), F.concat(value.cast("string"), F.lit(f" {unit}")))
    return out


def escape_path(path: Column) -> Column:
    """Backslash, separator, line feed and carriage return written as escapes."""
    for plain, written in (("\\", "\\\\"), ("\x1c", "\\034"), ("\n", "\\n"), ("\r", "\\r")):
        path = F.replace(path, F.lit(plain), F.lit(written))
    return path


def normalised_path(path: Column, mount: str | None = None, medium: Column | None = None) -> Column:
    """Without a partition prefix (p1:) and, if given, the mount point and the medium's folder; written \\r and \\n are the characters."""
    out = F.regexp_replace(path, r"^p\d+:", "")
    for prefix in ([F.lit(mount.rstrip("/"))] if mount else []) + ([F.concat(F.lit("/"), medium)] if medium is not None else []):
        out = F.when(F.startswith(out, F.concat(prefix, F.lit("/"))), F.substring(out, F.length(prefix) + 1, F.length(out))).otherwise(out)
    for written, plain in (("\\r", "\r"), ("\\n", "\n")):
        out = F.replace(out, F.lit(written), F.lit(plain))
    return out


def escaped_bytes(content: Column) -> Column:
    """Bytes as text: a zero byte or one above 127 as a backslash and three octal digits, a backslash doubled."""
    code = lambda ch: F.ascii(ch)
    one = lambda ch: F.when(ch == "\\", "\\\\").when((code(ch) > 127) | (code(ch) == 0), F.concat(F.lit("\\"), F.lpad(F.conv(code(ch).cast("string"), 10, 8), 3, "0"))).otherwise(ch)
    return F.array_join(F.transform(F.split(F.decode(content, "ISO-8859-1"), ""), one), "")


#: what an empty file is, whatever its medium
EMPTY_TYPE = "application/x-empty"


def identity(size: Column, content: Column) -> Column:
    """(blobid, mime_type) of a file; an empty one is never read."""
    empty = F.struct(content_hash(F.lit("")).alias("blobid"), F.lit(EMPTY_TYPE).alias("mime_type"))
    return F.when(size == 0, empty).otherwise(F.struct(content_hash(content).alias("blobid"), sniff_mime(content.cast("binary")).alias("mime_type")))


def pretty_json(doc: Column) -> Column:
    """A JSON document over several lines, keys in order."""
    return F.to_json(F.from_json(doc, "map<string,variant>"), {"pretty": "true"})


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def percent(a: Column, b: Column, places: int = 2) -> Column:
    return F.round(F.lit(100.0) * ratio(a, b), places)


def gibibytes(n: Column) -> Column:
    return F.round(n.cast("double") / 1073741824, 2)


def day_of(seconds: Column) -> Column:
    """The date (UTC) of seconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def content_hash(content: Column) -> Column:
    """Identity of a content in 64 hexadecimal digits."""
    return F.sha2(content, 256)


def is_blob_id(x: Column) -> Column:
    return x.rlike("^[0-9a-f]{64}$")


def smoothed(series: Column, alpha: float = 0.3) -> Column:
    """Exponential moving average at the end of an array of doubles; null for none."""
    start = F.element_at(series, 1)
    return F.when(F.size(series) > 0, F.aggregate(F.slice(series, 2, 1 << 30), start, lambda s, x: F.lit(alpha) * x + F.lit(1 - alpha) * s))


def verified(exists: Column, missing: Column, error: Column) -> Column:
    """A blob is good if it is there, no path is missing and nothing failed."""
    return exists & (F.size(missing) == 0) & error.isNull()


# Fixed values: (offset, bytes in hexadecimal, type) of a file's beginning; the first that fits counts.
MAGIC = (
    (0, "FFD8FF", "image/jpeg"), (0, "89504E470D0A1A0A", "image/png"), (0, "474946383761", "image/gif"), (0, "474946383961", "image/gif"), (0, "49492A00", "image/tiff"), (0, "4D4D002A", "image/tiff"),
    (0, "38425053", "image/vnd.adobe.photoshop"), (0, "25504446", "application/pdf"), (0, "25215053", "application/postscript"), (0, "504B0304", "application/zip"), (0, "1F8B", "application/gzip"), (0, "425A68", "application/x-bzip2"),
    (0, "FD377A585A00", "application/x-xz"), (0, "28B52FFD", "application/zstd"), (0, "377ABCAF271C", "application/x-7z-compressed"), (0, "526172211A07", "application/x-rar"), (257, "7573746172", "application/x-tar"), (0, "7F454C46", "application/x-executable"),
    (0, "CAFEBABE", "application/x-java-applet"), (0, "D0CF11E0A1B11AE1", "application/msword"), (0, "7B5C727466", "text/rtf"), (0, "53514C69746520666F726D6174203300", "application/vnd.sqlite3"), (0, "494433", "audio/mpeg"), (0, "664C6143", "audio/flac"),
    (0, "4F676753", "application/ogg"), (8, "57415645", "audio/x-wav"), (8, "41564920", "video/x-msvideo"), (8, "57454250", "image/webp"), (4, "66747970", "video/mp4"), (0, "000001BA", "video/mpeg"), (0, "1A45DFA3", "video/x-matroska"),
)
# How a text begins, blanks aside and in lower case, and its type.
TEXT_MAGIC = (("<!doctype html", "text/html"), ("<html", "text/html"), ("<?xml", "text/xml"), ("#!", "text/x-shellscript"), ("from: ", "message/rfc822"), ("begin:vcard", "text/vcard"))
HEAD = 2048


def sniff_mime(content: Column) -> Column:
    """MIME type by the first HEAD bytes: a known beginning, then text if they hold no NUL; an empty file has its own type."""
    head = F.substring(content, 1, HEAD)
    digits, text = F.hex(head), F.lower(F.trim(F.translate(F.decode(F.substring(content, 1, 64), "ISO-8859-1"), "\t\r\n", "   ")))
    out = F.when(content.isNull(), None).when(F.length(content) == 0, EMPTY_TYPE)
    for offset, magic, kind in MAGIC:
        out = out.when(F.substring(digits, 2 * offset + 1, len(magic)) == magic, kind)
    for begin, kind in TEXT_MAGIC:
        out = out.when(text.startswith(begin), kind)
    return out.when(~digits.rlike("^(?:..)*00"), "text/plain").otherwise("application/octet-stream")


def eta_seconds(done: Column, total: Column, elapsed: Column) -> Column:
    """Seconds left at the mean rate so far; null before the first item."""
    return (total - done).cast("double") * ratio(elapsed, done)
