"""Text functions: Column in, Column out, except where normal forms or positions need Python."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Look-alike letters and the Latin letters they pass for.
LOOKALIKES = {
    "Μ": "M", "Ο": "O", "ο": "o", "Ѕ": "S", "ѕ": "s", "Τ": "T", "Β": "B", "Е": "E", "е": "e", "М": "M", "О": "O", "о": "o", "Т": "T",
    "В": "B", "С": "C", "с": "c", "а": "a", "Α": "A", "ε": "e", "τ": "t", "і": "i", "Ι": "I", "ı": "i", "ѐ": "e", "ё": "e",
}
#: More letters of both scripts that look like Latin ones, for names that are spelt with any of them.
MORE_LOOKALIKES = dict(zip("вкмнртухακμνρυχАКНРУХΕΚΝΡΥΧЅ", "bkmhptyxakmvpuxAKHPYXEKNPYXS", strict=True))
_WIDE = LOOKALIKES | MORE_LOOKALIKES


def folded(text: str, wide: bool = False) -> str:
    """TX1 for one text. Only its different letters are looked at one by one; Latin letters are not replaced again."""
    import unicodedata

    if text.isascii():
        return text
    text, table = unicodedata.normalize("NFKD", text), _WIDE if wide else LOOKALIKES
    for c in set(text):
        if not c.isascii():
            latin = "" if unicodedata.combining(c) else table.get(c, c)
            if latin != c:
                text = text.replace(c, latin)
    return text


def fold(text: Column, wide: bool = False) -> Column:
    """TX1: compatibility decomposition, no combining marks, look-alike letters as Latin ones; wide takes MORE_LOOKALIKES as
    well, which changes ordinary words of their scripts."""

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else folded(t, wide) for t in (x.as_py() for x in texts)], pa.string())

    return run(text)


def count_matches(text: Column, pattern: str) -> Column:
    """TX3, TX4: matches of a pattern; null text has none. Prefix (?iU) for case-insensitive letters of any script."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def disguised_count(text: Column, latin: str, other: str | None = None) -> Column:
    """TX2: a name over the folded text, and its spelling in another script over the text itself."""
    return count_matches(fold(text), latin) + (count_matches(text, other) if other else F.lit(0))


def per_thousand(count: Column, length: Column) -> Column:
    """TX3: matches for each 1,000 characters, 0.0 for an empty text."""
    return F.when(length > 0, count * 1000.0 / length).otherwise(F.lit(0.0))


def first_in_dictionary(text: Column, entries: Sequence[tuple[str, str]]) -> Column:
    """TX5, JN11: the name of the first entry in order whose pattern matches, "" without one."""
    return F.coalesce(*[F.when(text.rlike(rx), F.lit(name)) for name, rx in entries], F.lit(""))


def all_in_dictionary(text: Column, entries: Sequence[tuple[str, str]], aliases: Mapping[str, str] | None = None, suppress: Mapping[str, str] | None = None) -> Column:
    """TX6: the names of all entries that match, in order and once each. aliases rename; suppress drops a name where the
    name it maps to is found as well."""
    aliases = aliases or {}
    found = F.array_distinct(F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(aliases.get(name, name))) for name, rx in entries])))
    for name, by in (suppress or {}).items():
        found = F.when(F.array_contains(found, by), F.array_remove(found, name)).otherwise(found)
    return found


def first_rule(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """TX7, FLT2: an ordered classifier, the first pattern that matches names the class."""
    out = None
    for name, rx in rules:
        out = F.when(text.rlike(rx), name) if out is None else out.when(text.rlike(rx), name)
    return F.lit(default) if out is None else out.otherwise(default)


def query_language(text: Column, country: Column | None = None, noise: Sequence[str] = (), brand: str | None = None, scripts: Sequence[tuple[str, str]] = (), words: Sequence[tuple[str, Sequence[str]]] = (), ties: Mapping[str, str] | None = None) -> Column:
    """TX8: the language of a short query: brand and noise words go, then scripts in order, then word lists in order,
    then the country's own language, else "other"; "none" where nothing is left."""
    t = F.lower(text)
    if brand:
        t = F.regexp_replace(t, brand, " ")
    left = F.filter(F.split(F.trim(t), r"\s+"), lambda w: (w != "") & ~w.isin(list(noise))) if noise else F.filter(F.split(F.trim(t), r"\s+"), lambda w: w != "")
    out = F.when(F.size(left) == 0, "none")
    for name, rx in scripts:
        out = out.when(F.array_join(left, " ").rlike(rx), name)
    for name, known in words:
        out = out.when(F.arrays_overlap(left, F.array(*[F.lit(w) for w in known])), name)
    for where, name in (ties or {}).items():
        if country is not None:
            out = out.when(country == where, name)
    return out.otherwise("other")


#: TX8, fixed values: words that say nothing about a query's language, letters of scripts, and words of languages.
QUERY_NOISE = r"(?i)^(kz|uz|az|com|net|org|ru|apk|ios|android|app|aviator|casino|bet|online|www|official|2024|2025|2026|\d+|[.\-_/]+)$"
KAZAKH_LETTERS = "[әғқңөұүһіӘҒҚҢӨҰҮҺІ]"
UZBEK_LETTERS = "[ўғқҳЎҒҚҲ]"
CYRILLIC_LETTERS = "[а-яёА-ЯЁ]"
AZERI_LETTERS = "[əƏ]"
QUERY_WORDS = {
    "az": r"yukle|yükle|yüklə|yukl[eə]|giri[sş]|qeydiyyat|r[eə]smi|proqram|idman|m[eə]rc|oyun|pulsuz|endir|azerbaycan|az[eə]rbaycan|c[iı]xar\w*|ç[iı]xar\w*|hesab|d[eə]st[eə]k|qazan\w*|saytı",
    "tr": r"indir|giriş|güncel|kayıt|canlı|adresi|bahis|mobil|uygulama|üyelik|para|çekme|yatırma|tv|türkiye",
    "uz": r"yuklab|yuklash|skachat|kirish|olish|o.?ynash|ro.?yxat\w*|bepul|uchun|rasmiy|sayti|ilova|onlayn|yechish|to.?ldirish|bukmeker|tikish|stavka|uzbekcha|o.?zbek\w*",
    "shared": r"bonus|sayt|pul|mobil|tv",
    "ru": r"skachat|zerkalo|vhod|vkhod|oficialn\w*|otzyvy|kazino|registraciya|prilozhenie|besplatno|segodnya|rabochee|sayt|stavki|bukmeker\w*",
    "pt": r"baixar|aplicativo|entrar|apostas|cadastro|login|bônus|bonus|oficial|site|jogo|jogos|brasil|cassino|saque|depósito",
    "es": r"descargar|aplicaci[oó]n|entrar|apuestas|registro|bono|oficial|casino|juego|iniciar|sesi[oó]n|retiro|dep[oó]sito|m[eé]xico|per[uú]|chile",
    "en": r"download|login|log in|sign ?up|register|registration|app|review|reviews|official|site|website|promo ?code|withdraw|withdrawal|deposit|sports|betting|mobile|version|free|play|games|slots|live|support|india|bangladesh|pakistan|nepal|english|kazakhstan|uzbekistan|azerbaijan|partners?|affiliate|agent|cash|demo|promo|code|bookmaker",
}


def brand_query_language(text: Column, country: Column, brand: str) -> Column:
    """TX8 with the published lists: brand_only, kk, uz_cyrillic, ru, az, tr, uz_latin, az_or_tr, ru_translit, pt, es, en or
    latin_unknown. Where words of several local languages stand in a query, the country's own wins."""
    said = lambda k: rest.rlike(rf"(?iU)\b({QUERY_WORDS[k]})\b")
    words = F.filter(F.split(F.trim(F.regexp_replace(text, brand, " ")), r"\s+"), lambda w: (w != "") & ~w.rlike(QUERY_NOISE))
    rest = F.array_join(words, " ")
    local = F.array_compact(F.array(F.when(rest.rlike(AZERI_LETTERS) | said("az"), F.lit("az")), F.when(said("tr"), F.lit("tr")), F.when(said("uz"), F.lit("uz_latin"))))
    local = F.when((F.size(local) == 0) & said("shared"), F.array(F.lit("az"), F.lit("uz_latin"))).otherwise(local)
    own = F.when(country == "AZ", "az").when(country == "UZ", "uz_latin")
    return (
        F.when(F.size(words) == 0, "brand_only")
        .when(rest.rlike(CYRILLIC_LETTERS) & rest.rlike(KAZAKH_LETTERS), "kk")
        .when(rest.rlike(CYRILLIC_LETTERS) & rest.rlike(UZBEK_LETTERS), "uz_cyrillic")
        .when(rest.rlike(CYRILLIC_LETTERS), "ru")
        .when(F.coalesce(F.array_contains(local, own), F.lit(False)), own)
        .when(F.array_contains(local, "az") & F.array_contains(local, "tr"), "az_or_tr")
        .when(F.size(local) > 0, F.try_element_at(local, F.lit(1)))
        .when(said("ru"), "ru_translit")
        .when(said("pt") & ~said("en"), "pt")
        .when(said("es") & ~said("en"), "es")
        .when(said("en"), "en")
        .otherwise("latin_unknown")
    )


def geo_code(text: Column, own: Column, countries: Sequence[tuple[str, str]]) -> Column:
    """TX9: own, own+X, none or the sorted foreign countries a text names, joined by +."""
    named = F.array_sort(F.array_compact(F.array(*[F.when(text.rlike(rx), F.lit(name)) for name, rx in countries])))
    foreign = F.array_join(F.array_remove(named, own), "+")
    has_own = F.array_contains(named, own)
    return F.when(F.size(named) == 0, "none").when(has_own & (foreign == ""), "own").when(has_own, F.concat(F.lit("own+"), foreign)).otherwise(foreign)


def collapse(text: Column, most: int | None = None) -> Column:
    """TX10: white space as single blanks, trimmed, at most so many characters."""
    one = F.trim(F.regexp_replace(text, r"\s+", " "))
    return one if most is None else F.substring(one, 1, most)


def _decoded(token: Column) -> Column:
    plain = F.translate(token, "-_", "+/")
    padded = F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))
    return F.try_validate_utf8(F.try_to_binary(padded, F.lit("base64")).cast("string"))


def base64_urls(text: Column) -> Column:
    """TX11: http(s) URLs hidden as Base64, with plain or URL-safe alphabet and missing padding."""
    tokens = F.regexp_extract_all(text, F.lit(r"(aHR0c[A-Za-z0-9+/_-]{6,})"), F.lit(1))
    return F.filter(F.transform(tokens, _decoded), lambda u: u.isNotNull() & u.rlike(r"^https?://"))


def base64_path(value: Column) -> Column:
    """TX12: a value that decodes to a path or URL, else ""."""
    out = _decoded(value)
    return F.when(value.rlike(r"^[A-Za-z0-9+/_-]{6,}={0,2}$") & out.rlike(r"^(/|https?://)[\x21-\x7e]+$"), out).otherwise("")


def without_comments(script: Column) -> Column:
    """TX13: a script without block comments, and without line comments whose slashes do not follow one of : \\ " ' =."""
    return F.regexp_replace(F.regexp_replace(script, r"(?s)/\*.*?\*/", " "), r"(?m)(?<![:\\\"'=])//[^\n]*", " ")


def script_url_live(url: Column, script: Column) -> Column:
    """TX13: whether a URL found in a page counts: it stands in the page's scripts outside comments, or not there at all."""
    key = F.regexp_replace(F.regexp_replace(url, r"^.*?://", ""), r"/+$", "")
    return ~script.contains(key) | without_comments(script).contains(key)


def short_hash(text: Column, digits: int = 12) -> Column:
    """TX14: the first hex digits of SHA-1."""
    return F.substring(F.sha1(text.cast("binary")), 1, digits)


def percent_decoded(text: Column) -> Column:
    """TX15: percent-decoding that keeps plus signs; undecodable text stays."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def cut_at_first(text: Column, markers: Sequence[str]) -> Column:
    """TX16: the text before the first of several end markers."""
    at = F.least(*[F.nullif(F.instr(text, m), F.lit(0)) for m in markers]) if len(markers) > 1 else F.nullif(F.instr(text, markers[0]), F.lit(0))
    return F.when(at.isNull(), text).otherwise(F.substring(text, F.lit(1), at - 1))


def clean_answer(text: Column, placeholders: Sequence[str], header: str, ends: Sequence[str]) -> Column:
    """TX16: an answer without placeholder sentences (patterns, removed in order), from the end of its header pattern to
    the first of the end patterns, trimmed."""
    t = text
    for rx in placeholders:
        t = F.trim(F.regexp_replace(t, rx, ""))
    start = F.instr(t, F.nullif(F.regexp_extract(t, header, 0), F.lit("")))
    t = F.when(F.coalesce(start, F.lit(0)) > 0, F.substring(t, start + F.length(F.regexp_extract(t, header, 0)), F.length(t))).otherwise(t)
    at = F.array_min(F.array_compact(F.array(*[F.nullif(F.instr(t, F.nullif(F.regexp_extract(t, rx, 0), F.lit(""))), F.lit(0)) for rx in ends])))
    return F.trim(F.when(at.isNotNull(), F.substring(t, F.lit(1), at - 1)).otherwise(t))


def _match_udf(pattern: str):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def positions(text: pd.Series) -> pd.Series:
        import re

        rx = re.compile(pattern, re.IGNORECASE)
        return text.map(lambda t: [] if t is None else [m.start() for m in rx.finditer(t)])

    return positions


def match_positions(text: Column, pattern: str) -> Column:
    """Where a pattern (Python's dialect, case-insensitive) matches, from 0."""
    return _match_udf(pattern)(text)


def contexts(text: Column, positions: Column, before: int = 160, after: int = 160) -> Column:
    """WN12: the text around positions."""
    return F.transform(positions, lambda p: F.substring(text, F.greatest(p - before, F.lit(0)) + 1, F.least(p, F.lit(before)) + after))


def near_count(text: Column, positions: Column, terms: str, width: int = 300) -> Column:
    """TX17: matches of terms within width characters of any position, each context counted by itself."""
    return F.aggregate(F.transform(contexts(text, positions, width, width), lambda c: count_matches(c, terms)), F.lit(0), lambda a, x: a + x)


def number(text: Column, default: float = 0.0) -> Column:
    """TX20: a number, or the default for whatever is none."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(default))


def grouped_number(value: Column) -> Column:
    """TX18: digits in groups of three with blanks between."""
    return F.regexp_replace(value.cast("bigint").cast("string"), r"(?<=\d)(?=(\d{3})+$)", " ")


def grouped_decimal(value: Column, digits: int = 1) -> Column:
    """TX18: a number with a decimal comma."""
    return F.translate(F.format_string(f"%.{digits}f", value.cast("double")), ".", ",")


def escaped(text: Column) -> Column:
    """TX18: markup characters as entities; null is ""."""
    out = F.coalesce(text, F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def linked(text: Column) -> Column:
    """TX18: escaped text whose URLs are links."""
    return F.regexp_replace(escaped(text), r"(https?://[^\s,()]+)", '<a href="$1">$1</a>')


def explain(code: Column, sentences: Sequence[tuple[str, str]]) -> Column:
    """TX19: the sentence of the first pattern that matches a reason code; $1 stands for its first group."""
    out = None
    for rx, sentence in sentences:
        said = F.regexp_replace(F.regexp_extract(code, rx, 0), rx, sentence)
        out = F.when(code.rlike(rx), said) if out is None else out.when(code.rlike(rx), said)
    return code if out is None else out.otherwise(code)


#: TX19: reason codes of the rules and what they mean, in order. $1 stands for the first group of the pattern.
REASONS = (
    (r"^redirect: (.*)$", "the home page sends visitors to $1"),
    (r"^script redirect: (.*)$", "a script of the home page sends visitors to $1"),
    (r"^hidden links(?:=(\d+))?.*$", "the brand stands in hidden links only"),
    (r"^links without topic.*$", "the site is about something else, the brand stands in links only"),
    (r"^head only.*$", "the brand stands in the title of a page about something else"),
    (r"^meta only.*$", "the domain names the brand, the page is an application's store page without a referral link"),
    (r"^moves to (\S+).*$", "a domain with the brand's name moves to $1"),
    (r"^never names.*$", "the domain names the brand, the page does not"),
    (r"^content=([^:]*):(\d+).*$", "another brand is named more often: $1, $2 times"),
    (r"^dominant density=(\S+).*$", "the brand dominates the page, $1 mentions per 1,000 characters"),
    (r"^name_in_(\w+).*$", "the brand stands in the $1 and dominates the page"),
    (r"^dated feed.*$", "a feed of dated articles"),
    (r"^posts.*$", "a feed of articles, the brand stands in single posts"),
    (r"^text_len=(\d+)$", "hardly any text, $1 characters"),
    (r"^placeholder.*$", "a placeholder text"),
    (r"^parking.*$", "a parking page"),
    (r"^(?:http|edge)_(\d+)$", "the server answers $1"),
    (r"^answered earlier: (.*)$", "answered in earlier scans, not in the last one"),
    (r"^timeout$", "no answer in time"),
    (r"^dns_fail$", "the domain does not resolve"),
)


#: TX21, fixed values: delimiters of flattened arrays.
DELIMITERS = {"tags": " ", "brands": " | ", "hops": " → ", "history": " > "}


def pack(values: Column, kind: str) -> Column:
    return F.array_join(values, DELIMITERS[kind])


def unpack(packed: Column, kind: str) -> Column:
    """The array behind a packed text; null or "" gives an empty one."""
    parts = F.split(F.coalesce(packed, F.lit("")), f"\\Q{DELIMITERS[kind]}\\E")
    return F.filter(parts, lambda p: p != "")


def chain_text(chain: Column) -> Column:
    """HP10: status or error and URL of each hop, with arrows between. chain: array of structs status, error, url."""
    return F.array_join(F.transform(chain, lambda h: F.concat_ws(" ", F.coalesce(h["status"].cast("string"), h["error"]), h["url"])), " → ")


#: HP11, fixed values: parts of a browser's error text and their codes, in order.
ERROR_CODES = (
    ("NS_ERROR_UNKNOWN_HOST", "dns_fail"),
    ("NS_ERROR_CONNECTION_REFUSED", "connection_refused"),
    ("NS_ERROR_NET_TIMEOUT", "timeout"),
    ("Timeout", "timeout"),
    ("NS_ERROR_NET_RESET", "connection_reset"),
    ("NS_ERROR_NET_INTERRUPT", "connection_reset"),
    ("NS_ERROR_NET_EMPTY_RESPONSE", "empty_response"),
    ("NS_ERROR_REDIRECT_LOOP", "redirect_loop"),
    ("SSL_ERROR", "tls_error"),
    ("SEC_ERROR", "tls_error"),
    ("NS_ERROR_OFFLINE", "offline"),
    ("Download is starting", "download"),
    ("NS_BINDING_ABORTED", "aborted"),
    ("NS_ERROR_ABORT", "aborted"),
    ("Target page, context or browser has been closed", "closed"),
)
#: HP11, fixed values: names of exceptions of a plain client and their codes; other names stay.
EXCEPTION_CODES = ((r"^(asyncio\.)?TimeoutError$", "timeout"), (r"SSL|Certificate", "tls_error"), (r"^ClientConnectorError$", "connect_error"))


def error_code(error: Column, default: str = "nav_error") -> Column:
    """HP11: the code of a recorded error text; "" without an error."""
    out = F.when(error.isNull() | (error == ""), "")
    for part, code in ERROR_CODES:
        out = out.when(F.contains(error, F.lit(part)), code)
    return out.otherwise(default)


def exception_code(name: Column) -> Column:
    """HP11: the code of an exception's name, or the name."""
    return F.coalesce(F.nullif(first_rule(name, [(code, rx) for rx, code in EXCEPTION_CODES], ""), F.lit("")), name)
