"""URL and host functions: Column in, Column out.

URLs are split by the generic pattern of RFC 3986, since parse_url raises on invalid URLs and gives NULL for hosts outside
ASCII. Null stays null unless a function says otherwise; text that is no URL has the host "".
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.config import DEFAULT, Config

#: scheme, authority, path, query, fragment
SPLIT = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, SPLIT, k)


def netloc(url: Column) -> Column:
    """The authority with port and user."""
    return _part(url, 2)


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def base_host(host: Column) -> Column:
    """UR1: lower case, no dots at the end, no leading www."""
    return F.regexp_replace(F.regexp_replace(F.lower(host), r"\.+$", ""), r"^www\.", "")


def hostname(url: Column) -> Column:
    """The host name without user and port, lower-cased; "" where there is none."""
    bare = F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":\d*$", "")
    return F.lower(bare)


def url_host(url: Column) -> Column:
    """UR2: hostname without www."""
    return F.regexp_replace(hostname(url), r"^www\.", "")


def loc_host(url: Column) -> Column:
    """UR3: the authority as it stands (port and user kept), lower-cased, no www."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def same_site(a: Column, b: Column, empty_matches: bool = False) -> Column:
    """UR4: equal hosts, or one ends with a dot and the other."""
    hit = (a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a))
    return hit if empty_matches else (a != "") & (b != "") & hit


def ref_key(url: Column) -> Column:
    """UR5, HP3: host and path without slashes at the end ("/" for the root), no query."""
    return F.concat(hostname(url), F.coalesce(F.nullif(F.regexp_replace(path(url), r"/+$", ""), F.lit("")), F.lit("/")))


def tracker_shaped(url: Column) -> Column:
    """UR10: the path is one token of 5 to 12 letters and digits in mixed case that is no title-case word."""
    token = F.regexp_extract(path(url), r"^/([A-Za-z0-9]{5,12})/?$", 1)
    return token.rlike(r"[a-z]") & token.rlike(r"[A-Z]") & ~token.rlike(r"^[A-Z][a-z]+$")


def cache_key(url: Column, site: Column, config: Config = DEFAULT) -> Column:
    """UR6: "" for links inside the site; host and path for referral or tracker shapes; else the URL without fragment."""
    shaped = tracker_shaped(url) | classify_ref(url, site, config).isNotNull()
    return F.when(same_site(base_host(hostname(url)), base_host(site), True), F.lit("")).when(shaped, ref_key(url)).otherwise(F.regexp_replace(url, r"#.*$", ""))


def dest_key(url: Column, site: Column, config: Config = DEFAULT) -> Column:
    """UR6: cache_key, or the URL without fragment inside the site."""
    return F.coalesce(F.nullif(cache_key(url, site, config), F.lit("")), F.regexp_replace(url, r"#.*$", ""))


def query_value(url: Column, name: str) -> Column:
    """UR7: the first value of a query parameter, decoded; "" where it is absent."""
    raw = F.regexp_extract(query(url), rf"(?:^|&){name}=([^&]*)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)


def partner_id(url: Column) -> Column:
    return query_value(url, "pid")


def has_affiliate_params(url: Column, config: Config = DEFAULT) -> Column:
    """UR8."""
    return query(url).rlike(config.affiliate_params)


def has_tracker_params(url: Column, config: Config = DEFAULT) -> Column:
    return query(url).rlike(config.tracker_params)


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, href: pd.Series) -> pd.Series:
    """UR9: a reference resolved against its page; null where either cannot be read."""
    from urllib.parse import urljoin

    def one(b: str | None, h: str | None) -> str | None:
        try:
            return urljoin(b or "", h) if h is not None else None
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def ref_host(host: Column, config: Config = DEFAULT) -> Column:
    """UR14: a host of the target's referral links, by its ending or by the registry."""
    known = host.isin(list(config.ref_hosts)) if config.ref_hosts else F.lit(False)
    return (host != "") & (host.rlike(config.ref_suffix) | known)


def random_host(host: Column, config: Config = DEFAULT) -> Column:
    """UR12: the marker or a referral ending; else a digit in the second-level label (the only label of a host without a
    dot), or vowels make less than 0.3 of its letters."""
    labels = F.split(host, r"\.")
    label = F.coalesce(F.try_element_at(labels, F.lit(-2)), host)
    letters, vowels = F.regexp_count(label, F.lit(r"\p{L}")), F.regexp_count(label, F.lit("[aeiouy]"))
    few = (letters > 0) & (vowels / F.when(letters > 0, letters) < 0.3)
    return host.contains(config.ref_marker) | host.rlike(config.ref_suffix) | label.rlike(r"\d") | F.coalesce(few, F.lit(False))


def parts(url: Column) -> Column:
    """Host name, path and query as a struct, for rules that ask for them many times: as a column of its own a URL is split
    once, and what Spark compiles of the rules stays small."""
    return F.struct(hostname(url).alias("host"), path(url).alias("path"), query(url).alias("query"))


def looks_tracker(url: Column, config: Config = DEFAULT, split: Column | None = None) -> Column:
    """UR11: a random host asked for more than its root, a short code with a capital or digit, or tracker parameters.

    split: the URL's parts, if there is a column of them."""
    host, p, q = (hostname(url), path(url), query(url)) if split is None else (split["host"], split["path"], split["query"])
    rooted = p.isin("", "/") & (q == "")
    code = p.rlike(r"^/[A-Za-z0-9_-]{4,12}/?$") & p.rlike(r"[A-Z0-9]")
    return (random_host(host, config) & ~rooted) | code | q.rlike(config.affiliate_params) | q.rlike(config.tracker_params)


def classify_ref(url: Column, site: Column, config: Config = DEFAULT, split: Column | None = None, bases: tuple[Column, Column] | None = None) -> Column:
    """UR13, HP3: known_ref_host, ref, brand_host or null, in the order of the guards.

    A URL that is not http(s), has no host or lies inside the site is none; a registered host is one whatever its path;
    platforms, shorteners and hosts that look like words are none; then short codes with a capital (title-case words and
    longer paths only on referral hosts), then the target's own hosts with a partner parameter. split: the URL's parts, if
    there is a column of them; bases: base hosts of URL and site, if there are columns of them.
    """
    host, p, q = (hostname(url), path(url), query(url)) if split is None else (split["host"], split["path"], split["query"])
    own, there = bases or (base_host(host), base_host(site))
    code, long_code, capital = p.rlike(r"^/[A-Za-z0-9]{4}/?$"), p.rlike(r"^/[A-Za-z0-9]{4}/"), F.substring(p, 2, 4).rlike("[A-Z]")
    word, on_ref = F.substring(p, 2, 4).rlike("^[A-Z][a-z]{3}$"), host.rlike(config.ref_suffix)
    known = host.isin(list(config.ref_hosts)) if config.ref_hosts else F.lit(False)
    none = F.lit(None).cast("string")
    return (
        F.when(~F.coalesce(url.rlike(r"(?i)^https?://"), F.lit(False)) | (host == "") | same_site(own, there, True), none)
        .when(known, F.lit("known_ref_host"))
        .when(host.rlike(config.platform_hosts) | host.rlike(config.not_ref_hosts) | ~random_host(host, config), none)
        .when(code & capital & (~word | on_ref), F.lit("ref"))
        .when(long_code & capital & on_ref, F.lit("ref"))
        .when(host.contains(config.ref_marker) & q.rlike(config.brand_params), F.lit("brand_host"))
    )


def brand_ref(url: Column, site: Column, config: Config = DEFAULT) -> Column:
    """UR14: a referral link of the target: on its hosts, or of the shape and on a referral host."""
    kind = classify_ref(url, site, config)
    return F.coalesce(kind.isin("known_ref_host", "brand_host") | ((kind == "ref") & ref_host(url_host(url), config)), F.lit(False))


def unwrap(url: Column, wrapper: str = r"(?i)(^|\.)(redirect|away)\.") -> Column:
    """UR15: the url parameter of a redirect wrapper, else the URL itself."""
    inner = query_value(url, "url")
    return F.when(url_host(url).rlike(wrapper) & (inner != ""), inner).otherwise(url)


@F.pandas_udf(T.StructType().add("host", T.StringType()).add("status", T.StringType()))
def idna_host(name: pd.Series) -> pd.DataFrame:
    """UR16: ASCII form of a domain, lower-cased, no www.; status ok, empty or error."""

    def one(d: str | None) -> tuple[str | None, str]:
        d = (d or "").strip().lower().rstrip(".").removeprefix("www.")
        if not d:
            return None, "empty"
        try:
            return d.encode("idna").decode("ascii"), "ok"
        except UnicodeError:
            return None, "error"

    return pd.DataFrame([one(d) for d in name], columns=["host", "status"])


#: UR17, fixed values: words that begin the path of a gate, and words of a path that redirects.
GATE_WORDS = ("go", "goto", "out", "visit", "click", "redirect", "redir", "recommends", "refer", "link", "reg", "register", "play", "bonus", "promo", "step-un", "get", "join", "signup")
REDIRECT_WORDS = (
    "go", "goto", "out", "link", "links", "visit", "click", "redirect", "redir", "r", "ref", "refer", "aff", "affiliate", "partner", "promo", "promocode", "bonus",
    "reg", "register", "registration", "signup", "sign-up", "join", "play", "bet", "download", "apk", "app", "apps", "get", "official", "site", "casino", "login", "enter",
    "vhod", "kirish", "giris", "qeydiyyat", "registro", "rejestracja", "registrace",
)
#: UR17, fixed values: endings of static files, parameters that hold a URL, shapes of dated and worded paths, bare gates.
STATIC_ENDINGS = ("css", "js", "mjs", "png", "jpe?g", "gif", "svg", "webp", "avif", "ico", "pdf", "xml", "json", "woff2?", "ttf", "eot", "mp4", "webm", "mp3", "zip", "rar")
URL_NAMES = ("url", "u", "to", "goto", "target", "dest", "link", "redirect", "out")
DATED = r"/20[012]\d/(0?[1-9]|1[0-2])/|/20[012]\d-\d\d-\d\d|/\d{4}/\d{2}/\d{2}/"
WORDED = r"(?i)/[a-z0-9Ѐ-ӿ%]+(?:-[a-z0-9Ѐ-ӿ%]+){3,}/?$"
BARE_GATES = ("/go/", "/goto/", "/out/", "/link/", "/visit/", "/redirect/", "/click/", "/go", "/goto", "/out")
SHAPES = {
    "gate": rf"(?i)^/({'|'.join(GATE_WORDS)})(/[^/]{{0,24}})?/?$",
    "dated": DATED,
    "slug": WORDED,
    "static": rf"(?i)\.({'|'.join(STATIC_ENDINGS)})(\?|$)",
    "redirect": rf"(?i)(^|/)({'|'.join(REDIRECT_WORDS)})([/?#._-]|$)",
}
URL_PARAM = rf"(?i)(^|&)({'|'.join(URL_NAMES)})="


def path_shapes(url: Column) -> Column:
    """UR17: a struct of booleans: gate, dated, slug, static, redirect, url_param and bare_gate."""
    p = path(url)
    flags = [p.rlike(rx).alias(name) for name, rx in SHAPES.items()]
    return F.struct(*flags, query(url).rlike(URL_PARAM).alias("url_param"), F.lower(p).isin(*BARE_GATES).alias("bare_gate"))


#: A short path of one token, and a capital or digit in it.
TOKEN_PATH, TOKEN_MARK = r"^/[A-Za-z0-9_-]{4,12}/?$", "[A-Z0-9]"
#: What Java takes for ends of lines, and the end of a text as $ finds it.
LINE_ENDS = "\\n\\r\\u0085\\u2028\\u2029"
TEXT_END = rf"(?=(?:\r\n|[{LINE_ENDS}])?\Z)"


def _compiled(java: str) -> re.Pattern:
    """One of the patterns above for Python: dot, $, digits and cases as Java reads them."""
    return re.compile(java.replace(".*", f"[^{LINE_ENDS}]*").replace("$", TEXT_END), re.ASCII)


_SPLIT, _USER, _PORT = _compiled(SPLIT), _compiled("^.*@"), _compiled(r":\d*$")
_DOTS, _WWW, _WEB = _compiled(r"\.+$"), _compiled(r"^www\."), _compiled(r"(?i)^(https?:)?//|^/|^[^:]*$")
_GATE, _DATED, _SLUG = (_compiled(SHAPES[name]) for name in ("gate", "dated", "slug"))
_TOKEN_PATH, _TOKEN_MARK = _compiled(TOKEN_PATH), _compiled(TOKEN_MARK)
#: What link_parts gives.
LINK_PARTS = "host:string,base:string,path:string,query:string,web:boolean,gate:boolean,dated:boolean,slug:boolean,coded:boolean"


def link_parts(url: str) -> dict[str, str | bool]:
    """The parts of one URL as hostname, base_host, path and query give them, whether it may lead to a page, and shapes of
    its path; for parsers, which meet the same URL many times."""
    found = _SPLIT.search(url)
    authority, path, query = (x or "" for x in found.group(2, 3, 4)) if found else ("", "", "")
    host = _PORT.sub("", _USER.sub("", authority)).lower()
    return {
        "host": host,
        "base": _WWW.sub("", _DOTS.sub("", host.lower())),
        "path": path,
        "query": query,
        "web": bool(_WEB.search(url)),
        "gate": bool(_GATE.search(path)),
        "dated": bool(_DATED.search(path)),
        "slug": bool(_SLUG.search(path)),
        "coded": bool(_TOKEN_PATH.search(path) and _TOKEN_MARK.search(path)),
    }


def in_hosts(host: Column, patterns: Sequence[str]) -> Column:
    """UR18: a host that matches any pattern of a configured list."""
    return host.rlike("|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def hosts_changed(start: Column, hops: Column) -> Column:
    """UR19: any hop lies on another host than the start."""
    return F.coalesce(F.exists(hops, lambda h: url_host(h) != url_host(start)), F.lit(False))


#: UR20, fixed values.
COUNTRY_TLDS = {"kz": "KZ", "uz": "UZ", "az": "AZ", "de": "DE", "fr": "FR", "es": "ES", "pl": "PL", "ru": "RU", "uk": "GB", "in": "IN"}


def tld_country(host: Column) -> Column:
    """UR20: the country of the last label, null for generic ones."""
    last = F.coalesce(F.try_element_at(F.split(host, r"\."), F.lit(-1)), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in COUNTRY_TLDS.items() for x in pair])
    return F.try_element_at(table, last)


def is_coded(urls: Column, config: Config = DEFAULT) -> Column:
    """HP1: any URL of an array carries a partner, tracker or invitation parameter."""
    return F.coalesce(F.exists(urls, lambda u: has_affiliate_params(u, config) | has_tracker_params(u, config) | query(u).rlike(config.code_params)), F.lit(False))


def via_tracker(url: Column, final: Column, hops: Column) -> Column:
    """HP2: some hop's host is neither the linked nor the final one."""
    ends = F.array(F.coalesce(url_host(url), F.lit("")), F.coalesce(url_host(final), F.lit("")))
    return F.coalesce(F.exists(hops, lambda h: (url_host(h) != "") & ~F.array_contains(ends, url_host(h))), F.lit(False))


def tracked(url: Column, final: Column, hops: Column, config: Config = DEFAULT) -> Column:
    """DC5: partner or tracker parameters anywhere in the chain, a link with a query that lands on another host, or more
    than two hosts."""
    urls = F.concat(F.coalesce(hops, F.array().cast("array<string>")), F.array(F.coalesce(url, F.lit("")), F.coalesce(final, F.lit(""))))
    hosts = F.filter(F.array_distinct(F.transform(urls, url_host)), lambda h: h != "")
    first = F.coalesce(F.try_element_at(hops, F.lit(1)), url)
    moved = (query(first) != "") & (url_host(first) != "") & (url_host(final) != "") & (url_host(first) != url_host(final))
    marked = F.exists(urls, lambda u: has_affiliate_params(u, config) | has_tracker_params(u, config))
    return F.coalesce(marked, F.lit(False)) | F.coalesce(moved, F.lit(False)) | (F.size(hosts) > 2)


def clean_link(url: Column) -> Column:
    """HP9: escaped slashes undone, trimmed."""
    return F.trim(F.replace(url, F.lit("\\/"), F.lit("/")))
