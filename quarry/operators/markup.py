"""Fields of captured pages by regular expressions on the JVM.

For pages whose markup is known and regular: one pass of built-in functions
per field, pruned and pushed down like any other column.  Pages that need
selectors go through ``extract``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Character references that are decoded, the ampersand last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

#: A list item that is one link: its address and its text.
LINK_ITEM = r'<li\b[^>]*><a\b[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>'


def plain_text(markup: Column) -> Column:
    """References decoded, white space runs as one blank, trimmed; blank text is NULL."""
    for reference, char in REFERENCES:
        markup = F.replace(markup, F.lit(reference), F.lit(char))
    return F.nullif(F.trim(F.regexp_replace(markup, r"\s+", " ")), F.lit(""))


def element_text(html: Column, tag: str, inside: str | None = None) -> Column:
    """Text of the first ``tag`` element without markup of its own, after the first ``inside`` element begins if named."""
    start = rf"<{inside}\b[^>]*>.*?" if inside else ""
    return plain_text(F.regexp_extract(html, rf"(?s){start}<{tag}\b[^>]*>(.*?)</{tag}>", 1))


#: Scheme, host, path, query and fragment of an address, each with its mark; absent ones are empty.
ADDRESS = r"(?s)^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _without_dots(path: Column) -> Column:
    """A path from the root without ``.`` and ``..`` segments; ``..`` never leaves the root."""
    segments = F.split(path, "/")
    shorter = lambda done: F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"), lambda done, x: (
        F.when(x == "..", shorter(done)).when(x == ".", done).otherwise(F.concat(done, F.array(x)))))
    folder = F.element_at(segments, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))


def absolute(link: Column, base: Column) -> Column:
    """I8: ``link`` as the page at ``base`` means it, by the rules for references (RFC 3986, 5.2).

    Handles links from the root, relative paths with dot segments, ``?query``, ``#fragment`` and
    ``//host``; links with a scheme (``mailto:`` too) stay as they are.  An empty link is the page
    itself without fragment.  White space around a link goes.  A null link is null; without a base a
    link stays as it is.
    """
    link, base = F.regexp_replace(link, r"^\s+|\s+$", ""), F.coalesce(base, F.lit(""))
    scheme, host, path, query, fragment = (F.regexp_extract(link, ADDRESS, i) for i in range(1, 6))
    base_scheme, base_host, base_path, base_query = (F.regexp_extract(base, ADDRESS, i) for i in range(1, 5))
    from_root = (F.when(path.startswith("/"), path).when((base_host != "") & (base_path == ""), F.concat(F.lit("/"), path))
                 .otherwise(F.concat(F.regexp_extract(base_path, r"(?s)^(.*/)?", 0), path)))
    clean = F.when(from_root.startswith("/") & from_root.contains("/."), _without_dots(from_root)).otherwise(from_root)
    site = F.concat(base_scheme, base_host)
    plain = link.startswith("/") & ~link.startswith("//") & ~link.contains("/.")
    return (F.when((base == "") | (scheme != ""), link).when(plain, F.concat(site, link))
            .when(host != "", F.concat(base_scheme, link))
            .when(path == "", F.concat(site, base_path, F.when(query != "", query).otherwise(base_query), fragment))
            .otherwise(F.concat(site, clean, query, fragment)))


def link_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without html, with ``items``: (href, text) of every list item that is a link, in page order."""
    find = lambda group: F.regexp_extract_all(F.col(html), F.lit(LINK_ITEM), F.lit(group))
    items = F.zip_with(find(1), find(2), lambda href, text: F.struct(href.alias("href"), text.alias("text")))
    return pages.withColumn("items", items).drop(html)


def last_text(items: Column) -> Column:
    """The last item text that is not blank."""
    texts = F.filter(F.transform(items, lambda x: plain_text(x["text"])), lambda t: t.isNotNull())
    return F.try_element_at(texts, F.lit(-1))
