"""Product name, price and description out of crawled pages, as column expressions over `html`.

Everything runs in the JVM, in one narrow stage.  JSON-LD is read through VARIANT.  Where tags
must be looked at, the page is cut once into an array of tag and text tokens and elements are
followed to their matching close tag by counting depth, so nested tags of the same name are whole.

Limits: an element that is never closed runs to the end of the page, and tags whose quotes do not
balance are read as text.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import bind, clean_text, decode_entities, filled

MISSING = "N/A"
FETCH_FAILED = "Failed to fetch"
PRICE_STRUCTURED = "price_structured"

# Selectors in the order they are tried.
PRICE_CLASSES = ["price", "product-price", "sale-price"]
PRICE_ATTRIBUTE = "data-price"
DESCRIPTION_CLASSES = ["product-description", "description", "product-details"]
JSON_LD_TYPE = "application/ld+json"

# Elements that have no content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"]

# Possessive quantifiers: Java matches them in a loop, so long tags cannot overflow the stack.
IN_TAG = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
SCRIPT = rf"(?is)<!--.*?-->|<script(?=[\s>/]){IN_TAG}>.*?</script\s*>"
HIDDEN = rf"(?is)<!--.*?-->|<(script|style|template)(?=[\s>/]){IN_TAG}>.*?</\1\s*>|<!doctype[^>]*>"
TOKEN = rf"(?s)</?[a-zA-Z]{IN_TAG}>|[^<]++|<"

DIGIT = r"[\p{Nd}\x{00B2}\x{00B3}\x{00B9}\x{2070}-\x{2079}\x{2080}-\x{2089}]"


def attribute_lead(name: str) -> str:
    """Pattern for an open tag up to and including an attribute's name.  It steps over whole
    attributes, so `name=` inside another value does not count."""
    named = f"(?i:{name})"
    other = (rf"(?!{named}[\s=>/])[^\s=>/\"']++"
             r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"']++))?+")
    return rf"(?s)^<[a-zA-Z][^\s>/]*+(?:[\s/]++{other})*+[\s/]++{named}"


def attribute_test(name: str, value: str | None = None, word: bool = False) -> str:
    """Pattern for an open tag holding an attribute: with any value, with this exact value, or with
    this word among the space-separated words of its value."""
    lead = attribute_lead(name)
    if value is None:
        return lead + r"(?:[\s=>/]|$)"
    if word:
        inside = (rf"(?:\"(?:[^\"]*\s)?{value}(?:\s[^\"]*)?\"|'(?:[^']*\s)?{value}(?:\s[^']*)?'"
                  rf"|{value}(?=[\s>]))")
    else:
        inside = rf"(?:\"{value}\"|'{value}'|{value}(?=[\s>/]))"
    return lead + r"\s*=\s*" + inside


def attribute_value(tag: Column, name: str) -> Column:
    """Value of an attribute of an open tag as written; '' when absent."""
    start = attribute_lead(name) + r"\s*=\s*"
    found = F.regexp_extract(tag, start + r"(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)", 0)
    return F.regexp_replace(F.regexp_replace(found, start, ""), r"^[\"']|[\"']$", "")


def json_ld_scripts(html: Column) -> Column:
    """Texts of the JSON-LD scripts in document order; comments are stepped over."""
    scripts = F.filter(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(0)),
                       lambda s: s.rlike(attribute_test("type", JSON_LD_TYPE.replace("+", r"\+"))))
    return F.transform(scripts, lambda s: F.regexp_replace(
        F.regexp_replace(s, rf"(?is)^<script{IN_TAG}>", ""), r"(?is)</script\s*>$", ""))


def json_ld_product(scripts: Column) -> Column:
    """First object with `@type` exactly "Product", alone or inside a top-level list (VARIANT).

    A script that is not JSON is skipped, and so is the rest of a list after an entry that is not
    an object.
    """
    def product_of(text: Column) -> Column:
        v = F.try_parse_json(text)
        items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))

        def is_object(i: Column) -> Column:
            return F.schema_of_variant(i).startswith("OBJECT")

        def is_product(i: Column) -> Column:
            kind = F.try_variant_get(i, "$['@type']", "string")
            return is_object(i) & F.coalesce(kind == "Product", F.lit(False))

        stop = F.filter(items, lambda i: ~is_object(i) | is_product(i))
        hit = F.get(stop, F.lit(0))
        return F.when(v.isNotNull() & is_product(hit), hit)

    found = F.filter(F.transform(scripts, product_of), lambda p: p.isNotNull())
    return F.get(found, F.lit(0))


def truthy(v: Column, path: str) -> Column:
    """Text of a JSON value; NULL when it is absent or counts as false (null, "", 0, false, [], {})."""
    text = F.try_variant_get(v, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    empty = (
        (text == "")
        | ((kind == "BOOLEAN") & (text == "false"))
        | (kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (text.try_cast("double") == 0))
        | text.isin("[]", "{}")
    )
    return F.when(text.isNotNull() & ~empty, text)


def json_ld_price(product: Column) -> Column:
    """`{currency} {price}` of the first offer, trimmed."""
    listed = F.try_variant_get(product, "$.offers", "array<variant>")
    offer = F.coalesce(F.get(listed, F.lit(0)),
                       F.when(listed.isNull(), F.try_variant_get(product, "$.offers", "variant")))
    price = truthy(offer, "$.price")
    currency = F.coalesce(F.try_variant_get(offer, "$.priceCurrency", "string"), F.lit(""))
    return F.trim(F.concat(currency, F.lit(" "), price))


def page_tokens(html: Column) -> Column:
    """Tag and text tokens of the visible page: array of (text, name, kind), kind 1 for an open
    tag, -1 for a close tag, 0 for text and for tags without content."""
    pieces = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(TOKEN), F.lit(0))

    named = F.transform(pieces, lambda t: F.struct(t.alias("text"), F.when(
        t.rlike("^</?[a-zA-Z]"), F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1))
    ).otherwise("").alias("name")))

    def kind(t: Column) -> Column:
        return (F.when(t["name"] == "", 0).when(t["text"].startswith("</"), -1)
                .when(t["text"].endswith("/>") | t["name"].isin(VOID), 0).otherwise(1))

    return F.transform(named, lambda t: F.struct(
        t["text"].alias("text"), t["name"].alias("name"), kind(t).alias("kind")))


def candidate_tags(tokens: Column) -> Column:
    """Open tags that some selector may pick, with their 1-based position.  One cheap test per
    tag; the selectors then look at these few tags only."""
    words = "|".join([*PRICE_CLASSES, PRICE_ATTRIBUTE, *DESCRIPTION_CLASSES])
    placed = F.transform(tokens, lambda t, i: F.struct(
        t["text"].alias("text"), t["name"].alias("name"), t["kind"].alias("kind"),
        (i + 1).alias("at")))
    return F.filter(placed, lambda t: (t["name"] != "") & (t["kind"] >= 0) & (
        t["name"].isin("meta", "h1", "title") | t["text"].rlike(f"(?i){words}")))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def by_name(name: str) -> str:
    return f"t.name = {quoted(name)}"


def by_class(css_class: str) -> str:
    return f"t.text RLIKE {quoted(attribute_test('class', css_class, word=True))}"


def by_attribute(name: str) -> str:
    return f"t.text RLIKE {quoted(attribute_test(name))}"


def meta_with(attribute: str, value: str) -> str:
    return f"{by_name('meta')} AND t.text RLIKE {quoted(attribute_test(attribute, value))}"


def first_tags(tags: str, tests: list[str]) -> Column:
    """For each test (SQL over a tag `t`) the first candidate that passes, NULL when none does.
    One SQL text: a dozen lambdas built call by call take the driver seconds."""
    picks = [f"get(filter({tags}, t -> {test}), 0)" for test in tests]
    return F.expr(f"array({', '.join(picks)})")


def element_text(tokens: Column, tag: Column) -> Column:
    """Decoded text inside the element that `tag` opens; NULL when there is no tag."""
    def inside(rest: Column) -> Column:
        state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
        walked = F.aggregate(
            rest, state,
            lambda a, t: F.when(a["depth"] == 0, a).otherwise(F.struct(
                (a["depth"] + F.when(t["name"] == tag["name"], t["kind"]).otherwise(0)).alias("depth"),
                (a["n"] + 1).alias("n"))))
        texts = F.filter(F.slice(rest, F.lit(1), walked["n"]), lambda t: t["name"] == "")
        return F.array_join(F.transform(texts, lambda t: t["text"]), "")

    text = bind(F.slice(tokens, tag["at"] + 1, F.size(tokens)), inside)
    return F.when(tag.isNotNull(), F.when(tag["kind"] == 0, F.lit(""))
                  .otherwise(bind(text, decode_entities)))


def meta_content(tag: Column) -> Column:
    """Non-empty `content` of a meta tag."""
    return F.when(tag.isNotNull(), F.nullif(bind(attribute_value(tag["text"], "content"),
                                                 decode_entities), F.lit("")))


@lru_cache(maxsize=16)
def _steps(application: str, suffixes: tuple[str, ...]) -> tuple[list[dict[str, Column]], dict[str, Column]]:
    """Helper columns, step by step, and the output columns, over `current_url` and `_html`.

    The expressions name columns only, so they are built once per application and suffix list.
    """
    html, ld, tokens = F.col("_html"), F.col("_ld"), F.col("_tokens")
    elements = {"h1": by_name("h1"), "title": by_name("title"),
                **{c: by_class(c) for c in (*PRICE_CLASSES, *DESCRIPTION_CLASSES)},
                PRICE_ATTRIBUTE: by_attribute(PRICE_ATTRIBUTE)}
    metas = {"og:title": meta_with("property", "og:title"),
             "description": meta_with("name", "description"),
             "og:description": meta_with("property", "og:description")}

    def clean(c: Column) -> Column:
        return bind(c, lambda t: F.when(t.isNotNull(), clean_text(t, suffixes)))

    found = ["_ld_name", "_ld_price", "_ld_description"]
    needs_tags = filled(html) & F.array_contains(F.array(*[F.col(c).isNull() for c in found]), True)
    steps = [
        {"_ld": json_ld_product(json_ld_scripts(html))},
        dict(zip(found, (truthy(ld, "$.name"), json_ld_price(ld), truthy(ld, "$.description")))),
        {"_tokens": F.when(needs_tags, page_tokens(html))},
        {"_tags": candidate_tags(tokens)},
        # The picked tags sit in arrays, so that the long text expressions stand in the plan once.
        {"_elements": F.transform(first_tags("_tags", list(elements.values())),
                                  lambda tag: clean(element_text(tokens, tag))),
         "_metas": F.transform(first_tags("_tags", list(metas.values())),
                               lambda tag: clean(meta_content(tag)))},
    ]

    def element(name: str) -> Column:
        return F.get("_elements", F.lit(list(elements).index(name)))

    def meta(name: str) -> Column:
        return F.get("_metas", F.lit(list(metas).index(name)))

    def field(sources: list[Column]) -> Column:
        return F.when(filled(html), F.coalesce(*sources, F.lit(MISSING))).otherwise(F.lit(MISSING))

    output = {
        # A name that reads 'N/A' counts as missing for the next source.
        "product_name": field([F.nullif(c, F.lit(MISSING)) for c in (
            clean(F.col("_ld_name")), meta("og:title"), element("h1"), element("title"))]),
        "price": field([F.col("_ld_price"), *(F.when(element(n).rlike(DIGIT), element(n))
                                              for n in (*PRICE_CLASSES, PRICE_ATTRIBUTE))]),
        "description": field([clean(F.col("_ld_description")), *map(element, DESCRIPTION_CLASSES),
                              meta("description"), meta("og:description")]),
        "current_url": F.col("current_url"),
        "error": F.when(~filled(html), F.lit(FETCH_FAILED)),
        # In JSON-LD a point is always the decimal mark.
        PRICE_STRUCTURED: F.coalesce(filled(html) & F.col("_ld_price").isNotNull(), F.lit(False)),
    }
    return steps, output


def extract_product_info(pages: DataFrame, url: str = "url", html: str = "html",
                         suffixes: list[str] | tuple[str, ...] = (), structured: bool = False) -> DataFrame:
    """pages(url, html) to product_name, price, description, current_url and error; `structured` adds
    `price_structured`: whether the price comes from JSON-LD.

    Each field falls through its sources in order and ends at 'N/A'; a page without html gives
    'N/A' everywhere and an error.  Tags are only tokenised where JSON-LD leaves a field open.
    """
    steps, output = _steps(pages.sparkSession.sparkContext.applicationId, tuple(suffixes))
    rows = pages.select(F.col(url).alias("current_url"), F.col(html).alias("_html"))
    for columns in steps:
        rows = rows.withColumns(columns)
    return rows.select([c.alias(name) for name, c in output.items() if structured or name != PRICE_STRUCTURED])


def crawl_outcome(product_info: DataFrame) -> DataFrame:
    """How many pages succeeded and how many failed."""
    outcome = F.when(F.col("error").isNull(), F.lit("success")).otherwise(F.lit("error"))
    return product_info.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("pages"))
