"""String helpers over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(chr(k) for k in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: str | Column) -> Column:
    """White space off both ends, Unicode's too."""
    return F.btrim(col(c), F.lit(WHITE))


def strip_line_end(c: str | Column) -> Column:
    """CR and LF off the end of a line, however many."""
    return F.rtrim(col(c), F.lit("\r\n"))


def one_line(c: str | Column) -> Column:
    """CR and LF become spaces."""
    return F.translate(col(c), "\r\n", "  ")


def safe_file_name(c: str | Column) -> Column:
    """Characters that file systems refuse (fixed values) become underscores."""
    return F.regexp_replace(col(c), r'[\\/*?:"<>|]', "_")


def absolute_link(c: str | Column, base: str) -> Column:
    """A link that does not begin with http is put after base."""
    return F.when(col(c).startswith("http"), col(c)).otherwise(F.concat(F.lit(base), col(c)))


def decode_line(c: str | Column) -> Column:
    """Bytes as UTF-8 if they are that, else as ISO-8859-1, which takes any byte."""
    b = col(c).cast("binary")
    return F.when(F.is_valid_utf8(b.cast("string")), F.decode(b, "UTF-8")).otherwise(F.decode(b, "ISO-8859-1"))


def item_number(c: str | Column) -> Column:
    """First digits of an item label as a number; null without digits."""
    return F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int")


def item_prefix(c: str | Column) -> Column:
    """What stands before the digits of an item label."""
    return F.regexp_extract(col(c), r"^(\D*)", 1)
