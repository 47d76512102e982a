"""Text expressions: keys, tokens, URLs and masks, all as JVM columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: Masks of a failure's variable parts, applied in this order.
MASKS = (
    (r"https?://[^ ]+", "<url>"),
    (r"[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+Z?)?", "<time>"),
    (r"\b[0-9a-f]{12,64}\b", "<hash>"),
    (r"/[A-Za-z0-9_./-]+", "<path>"),
    (r'"[^"]*"', "<text>"),
    (r"[0-9]+", "<n>"),
    (r"\s+", " "),
)
#: What must not leave the engine in a text.
SECRETS = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"), (r"(?i)(password|token|secret|api[_-]?key)\s*[=:]\s*[^ \n]+", "$1=<secret>"))


def fold(x: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(x), ACCENTED, PLAIN)


def slug(x: Column) -> Column:
    """Runs of letters and digits joined by hyphens."""
    return F.btrim(F.regexp_replace(fold(x), "[^a-z0-9]+", "-"), F.lit("-"))


def name_key(x: Column) -> Column:
    return F.regexp_replace(fold(x), "[^a-z0-9]+", "")


def category_key(x: Column) -> Column:
    """Words of a category, `&` as and, without a plural s."""
    words = F.split(slug(F.replace(x, F.lit("&"), F.lit(" and "))), "-")
    return F.array_join(F.transform(words, singular), "-")


def singular(word: Column) -> Column:
    return F.when((F.length(word) > 3) & word.endswith("s") & ~word.endswith("ss"), F.substr(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def tokens(x: Column, stop: tuple[str, ...] = ()) -> Column:
    """Folded words of at least two characters, without stop words and a plural s."""
    words = F.filter(F.split(F.btrim(F.regexp_replace(fold(x), "[^a-z0-9]+", " ")), " "), lambda w: (F.length(w) > 1) & ~w.isin(*(stop or ("",))))
    return F.transform(words, singular)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host without www. and path of an http or https URL; null for any other."""
    web = url.rlike("^(?i)https?://[^/?#]+")
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1)), r"^www\.|\.$", "")
    path = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1)
    return F.when(web, host), F.when(web, F.when(path == "", "/").otherwise(path))


def repo_key(url: Column) -> tuple[Column, Column]:
    """host/first/second of a URL's host and path, or null and the reason."""
    host, path = host_path(url)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    last = F.regexp_replace(F.element_at(parts, 2), r"\.(git|html)$", "")
    reason = F.when(host.isNull(), "not_a_web_url").when(F.size(parts) < 2, "no_owner_or_name")
    return F.when(reason.isNull(), F.concat_ws("/", host, F.lower(F.element_at(parts, 1)), F.lower(last))), reason


def links(html: Column, most: int | None = None) -> Column:
    """Targets of a page's links in order, each once, entities decoded."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)"'), F.lit(1)), lambda u: F.replace(F.replace(u, F.lit("&amp;"), F.lit("&")), F.lit("&#x2F;"), F.lit("/")))
    return F.slice(F.array_distinct(found), 1, most) if most else F.array_distinct(found)


def mask(x: Column, masks: tuple[tuple[str, str], ...] = MASKS) -> Column:
    return reduce(lambda c, m: F.regexp_replace(c, m[0], m[1]), masks, x)


def fingerprint(x: Column) -> Column:
    """Twelve hexadecimal digits of the masked text's hash."""
    return F.substring(F.sha2(F.lower(mask(x)), 256), 1, 12)


def truncated(x: Column, n: int) -> Column:
    """White space collapsed; longer texts end in an ellipsis."""
    flat = F.btrim(F.regexp_replace(x, r"\s+", " "))
    return F.when(F.length(flat) > n, F.concat(F.rtrim(F.substring(flat, 1, n - 1)), F.lit("…"))).otherwise(flat)


def excerpt(x: Column, phrase: Column, around: int) -> Column:
    """Text around the first place of a phrase; null where it is absent."""
    at = F.position(phrase, x)
    return F.when(at > 0, F.substr(x, F.greatest(at - around, F.lit(1)), F.length(phrase) + 2 * around))


def version_tuple(x: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(x, "^v", ""), r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))
