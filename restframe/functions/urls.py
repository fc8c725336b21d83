"""URL text as Columns: form encoding, query parsing, adding a parameter, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BROKEN_ESCAPE = "%(?![0-9A-Fa-f]{2})"


def form_encode(value: Column) -> Column:
    """application/x-www-form-urlencoded text, UTF-8."""
    return F.url_encode(value)


def form_decode(value: Column) -> Column:
    """Inverse of ``form_encode`` that keeps malformed ``%`` escapes as they are."""
    # A malformed escape swallows the two characters after it, so "%%41" stays "%%41".
    pieces = F.regexp_extract_all(value, F.lit("(?s)(%[0-9A-Fa-f]{2}|%..|[^%]+|%)"), F.lit(1))
    repaired = F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(p.startswith("%") & p.rlike(_BROKEN_ESCAPE), F.url_encode(p)).otherwise(p),
        ),
        "",
    )
    return F.url_decode(F.when(value.rlike(_BROKEN_ESCAPE), repaired).otherwise(value))


def _token(text: Column) -> Column:
    """Trim, and collapse runs of blanks, as the query tokenizer does."""
    return F.regexp_replace(
        F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", ""), r"[ \t\r\n]+", " "
    )


def query_params(query: Column) -> Column:
    """A raw query string as ``array<struct<name, value>>`` in order, duplicates kept."""

    def split_pair(piece: Column) -> Column:
        cut = F.instr(piece, "=")
        name = F.when(cut > 0, F.substring_index(piece, "=", 1)).otherwise(piece)
        value = F.when(cut > 0, piece.substr(cut + 1, F.length(piece)))
        return F.struct(
            form_decode(_token(name)).alias("name"), form_decode(_token(value)).alias("value")
        )

    return F.filter(
        F.transform(F.split(query, "[&;]"), split_pair), lambda p: p["name"] != ""
    )


def format_params(params: Column) -> Column:
    """``array<struct<name, value>>`` as a form-encoded query string."""
    return F.array_join(
        F.transform(
            params,
            lambda p: F.when(p["value"].isNull(), form_encode(p["name"])).otherwise(
                F.concat(form_encode(p["name"]), F.lit("="), form_encode(p["value"]))
            ),
        ),
        "&",
    )


def url_part(url: Column, part: str) -> Column:
    return F.try_parse_url(url, F.lit(part))


def url_query(url: Column) -> Column:
    return url_part(url, "QUERY")


def is_valid_url(url: Column) -> Column:
    """False for text that is not a URI (a blank, a stray brace, a broken escape)."""
    # Every valid URI has a scheme or a (maybe empty) path.
    return F.coalesce(url_part(url, "PROTOCOL"), url_part(url, "PATH")).isNotNull()


def add_parameter(url: Column, name: Column, value: Column) -> Column:
    """The URL with one more query parameter; null when the URL is invalid."""
    scheme = url_part(url, "PROTOCOL")
    authority = url_part(url, "AUTHORITY")
    fragment = url_part(url, "REF")
    existing = F.coalesce(
        query_params(url_query(url)), F.expr("cast(array() as array<struct<name:string,value:string>>)")
    )
    extra = F.array(F.struct(name.alias("name"), value.alias("value")))
    rebuilt = F.concat(
        F.coalesce(F.concat(scheme, F.lit(":")), F.lit("")),
        F.coalesce(F.concat(F.lit("//"), authority), F.lit("")),
        F.coalesce(url_part(url, "PATH"), F.lit("")),
        F.lit("?"),
        format_params(F.concat(existing, extra)),
        F.coalesce(F.concat(F.lit("#"), fragment), F.lit("")),
    )
    return F.when(is_valid_url(url), rebuilt)
