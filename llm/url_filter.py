"""URL rules with verdicts carried along redirects and canonical links.

A URL's own verdict comes from the longest rule that fits its host (or a parent
domain) and the start of its path.  Redirects and canonical links tie URLs
together; distributed connected components make each set of tied URLs one
class.  A URL without a rule of its own is blocked when any URL of its class is
blocked by a rule (a link target counts, whether or not it is a page here); an
explicit allow keeps the URL it fits, whatever its aliases say.

Links are read from the page: ``<link rel=canonical href=...>`` and
``<meta http-equiv=refresh content="...url=...">``; relative ones are resolved
against the page, after character references are decoded.  URLs are compared
without scheme and fragment, their dot segments removed.

Definitions for odd input: a NULL URL, or one without ``://``, has empty host
and path, no rule and no links, and is allowed; NULL html has no links;
repeated rows are judged each on its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import saved
from llm.components import connected_components

# --- fixed values: rules as (verdict, host and path) -------------------------
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
# --- end of fixed values ----------------------------------------------------

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://`` (empty without one)."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*+)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*+)", 1)


def _without_dots(path: Column) -> Column:
    """A path whose segments ``.`` and ``..`` are resolved."""

    def walk(acc: Column, segment: Column) -> Column:
        return (F.when(segment == ".", acc)
                .when(segment == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .otherwise(F.concat(acc, F.array(segment))))

    # a last segment of dots leaves its slash
    segments = F.split(F.regexp_replace(F.regexp_replace(path, r"^/", ""), r"(?<=^|/)(\.\.?)$", "$1/"), "/", -1)
    plain = F.aggregate(segments, F.array().cast("array<string>"), walk)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(plain, "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """A URL as it is compared with others: host, path without dot segments, and query."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*+(\?[^#]*+)?", 1)
    return F.concat(host_of(url), _without_dots(path_of(url)), query)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The longest fitting rule (text), else NULL.  ``rules`` is a short list:
    it becomes part of the expression."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(RULES if rules is None else rules, key=lambda r: (len(r[1]), r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    out = F.lit(None).cast("string")
    for verdict, text in RULES if rules is None else rules:
        out = F.when(rule == text, F.lit(verdict)).otherwise(out)
    return out


_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "num": "#", "percnt": "%",
          "equals": "=", "quest": "?", "sol": "/", "colon": ":", "semi": ";", "comma": ",", "period": ".", "plus": "+",
          "lowbar": "_", "commat": "@", "dollar": "$", "excl": "!", "ast": "*", "lpar": "(", "rpar": ")", "Tab": "\t",
          "NewLine": "\n"}
_BARE = ["amp", "AMP", "lt", "LT", "gt", "GT", "quot", "QUOT"]      # known without a semicolon, too
_REFERENCE = (r"&(?:#0*+[0-9]{1,7}+;?+|#[xX]0*+[0-9A-Fa-f]{1,6}+;?+|(?:" + "|".join([*_NAMED, *_BARE[1::2]]) + r");|(?:"
              + "|".join(_BARE) + r")(?![;=0-9A-Za-z]))")


def decoded(value: Column) -> Column:
    """An attribute's value with its character references decoded, each once."""

    def character(reference: Column) -> Column:
        name = F.regexp_replace(reference, r"[&;]", "")
        number = F.when(name.rlike(r"^#[xX]"), F.conv(F.substring(name, 3, 10), 16, 10)) \
            .when(name.startswith("#"), F.substring(name, 2, 10)).try_cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        out = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        for known, sign in [*_NAMED.items(), *[(b.upper(), _NAMED[b]) for b in _BARE[::2]]]:
            out = F.when(name == known, F.lit(sign)).otherwise(out)
        return F.coalesce(out, reference)

    pieces = F.zip_with(F.split(value, _REFERENCE, -1), F.regexp_extract_all(value, F.lit(_REFERENCE), F.lit(0)),
                        lambda gap, ref: F.concat(gap, F.coalesce(character(ref), F.lit(""))))
    return F.when(value.contains("&"), F.array_join(pieces, "")).otherwise(value)


def _attribute(tag: Column, name: str) -> Column:
    found = [F.regexp_extract(tag, rf"(?is)\b{name}\s*+=\s*+{value}", 1)
             for value in (r'"([^"]*+)"', r"'([^']*+)'", r"""([^\s"'>]++)""")]
    return F.trim(decoded(F.coalesce(*[F.when(f != "", f) for f in found], F.lit(""))))


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """An absolute URL for a link on the page at host and path; NULL for none."""
    base = F.concat(F.lit("//"), host)
    return (F.when(target == "", F.lit(None))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*+:"), F.lit(None))      # mailto: and the like
            .when(target.startswith("#"), F.lit(None))
            .when(target.startswith("/"), F.concat(F.lit("http:"), base, target))
            .when(target.startswith("?"), F.concat(F.lit("http:"), base, path, target))
            .otherwise(F.concat(F.lit("http:"), base, F.regexp_replace(path, r"[^/]*+$", ""),
                                F.when(path.contains("/"), F.lit("")).otherwise(F.lit("/")), target)))


def link_targets(html: Column, host: Column, path: Column) -> Column:
    """Where a page's canonical link and refresh lead, as an array of absolute URLs."""
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*+>"), F.lit(0)),
                 lambda t: F.lower(_attribute(t, "rel")).rlike(r"(?:^|\s)canonical(?:\s|$)")),
        lambda t: _attribute(t, "href"))
    refresh = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*+>"), F.lit(0)),
                 lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.trim(F.regexp_extract(_attribute(t, "content"), r"""(?is)url\s*+=\s*+['"]?([^'"\s]++)""", 1)))
    both = F.transform(F.concat(canonical, refresh), lambda t: _resolved(t, host, path))
    # the cheap test first: most pages have neither
    return F.when(html.rlike(r"(?i)canonical|http-equiv"), F.filter(both, lambda u: u.isNotNull())) \
        .otherwise(F.array().cast("array<string>"))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst): tied URLs, as compared."""
    u = F.col(url)
    linked = (pages.filter(_rest(u) != "")
              .select(node_of(u).alias("src"),
                      F.explode(link_targets(F.coalesce(F.col(html), F.lit("")), host_of(u), path_of(u))).alias("to")))
    return linked.select("src", node_of(F.col("to")).alias("dst")).filter((F.col("dst") != "") & (F.col("src") != F.col("dst")))


def judge(pages: DataFrame, extra_edges: DataFrame | None = None, url: str = "url", html: str = "html",
          rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every row of ``pages`` with ``_host``, ``_path``, ``_rule`` and ``_verdict``.
    ``extra_edges`` (src, dst) are further redirects between URLs, for instance
    from a crawler's log."""
    edges = alias_edges(pages, url, html)
    if extra_edges is not None:
        edges = edges.union(extra_edges.select(node_of(F.col("src")), node_of(F.col("dst"))))
    classes = connected_components(edges)
    # a node is its URL without the scheme; give it one to read its parts
    as_url = F.concat(F.lit("x://"), F.col("node"))
    own = verdict_of(rule_for(host_of(as_url), path_of(as_url), rules), rules)
    classes = saved(classes.withColumn("own", own), "classes")
    bad = classes.filter(F.col("own") == "block").select("component").distinct()
    tainted = (classes.filter(F.col("own").isNull()).join(bad, "component", "left_semi")
               .select(F.col("node").alias("_node")).distinct().withColumn("_tainted", F.lit(True)))
    u = F.col(url)
    judged = (pages.withColumn("_host", host_of(u)).withColumn("_path", path_of(u))
              .withColumn("_host", F.coalesce("_host", F.lit(""))).withColumn("_path", F.coalesce("_path", F.lit("")))
              .withColumn("_rule", rule_for(F.col("_host"), F.col("_path"), rules))
              .withColumn("_at", node_of(u))
              .join(tainted, F.col("_at") == F.col("_node"), "left"))
    verdict = F.coalesce(verdict_of(F.col("_rule"), rules),
                         F.when(F.col("_tainted"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.withColumn("_verdict", verdict).drop("_at", "_node", "_tainted")


def op5_urls(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    from llm.common import load

    return judge(load(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))
