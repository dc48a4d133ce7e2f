"""Configuration of the analytics: brand, competitors, lists and thresholds are data, never code.

The defaults name no real brand or host. Patterns are Java regular expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

#: Names of query parameters that mark a partner link.
AFFILIATE_NAMES = (
    "tag", "btag", "stag", "qtag", "pid", "p", "promo", "promocode", "ref", "aff", "affid", "aff_id", "affiliate", "sub1", "subid", "sub_id",
    "click_id", "clickid", "clid", "partner", "serial", "creative_id", "anid", "cid", "s1", "lp", "offer", "bonus_code",
)
#: Names of query parameters that trackers add.
TRACKER_NAMES = ("affiliatecode", "affiliate_code", "aff_code", "refcode", "referral", "wid", "ch", "campaign")
#: Names (patterns) of query parameters that carry an invitation code.
CODE_NAMES = ("code", "invite", "invitecode", "affiliatecode", "affiliate_code", r"sub\d", "buyer", "refcode")
#: Names of query parameters that mark a partner link on the brand's own hosts.
BRAND_PARAM_NAMES = ("pid", "p", "promo", "promocode", "btag", "stag", "ref", "aff")


def parameters(names: Sequence[str]) -> str:
    """A pattern that finds a parameter of one of these names in a query, in any case."""
    return f"(?i)(^|&)({'|'.join(names)})="


def under(hosts: Sequence[str]) -> str:
    """A pattern of hosts (patterns themselves) and all hosts below them."""
    return rf"(?i)(^|\.)({'|'.join(hosts)})$"


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the rules; every one can be replaced."""

    mono_density: float = 1.0
    dominance: float = 2.0
    other_dominant: int = 5
    topic_density: float = 2.0
    topic_words: int = 15
    sample_words: int = 2
    article_links: int = 15
    feed_dates: int = 5
    feed_articles: int = 3
    hidden_links: int = 3
    hacked_max_text: int = 3
    hacked_topic_density: float = 5.0
    topic_brands: int = 5
    title_brands: int = 3
    named_heads: int = 2
    head_text: int = 1000
    discredit_text: int = 1500
    common_word_topic: int = 5
    mirror_text: int = 6000
    mirror_mentions: int = 5
    stub_text: int = 300
    parked_text: int = 3000
    placeholder_text: int = 1500
    real_text: int = 50
    meta_text: int = 100
    thin_text: int = 200
    thin_links: int = 5
    empty_text: int = 30
    button_mentions: int = 3
    follow_budget: int = 12
    max_hops: int = 8
    branded_plain_links: int = 3
    inner_links: int = 4
    array_cap: int = 30
    fit_prior: float = 4.0
    class_prior: float = 3.0
    clamp: float = 1e-6
    raw_low: float = 0.05
    raw_high: float = 0.98


@dataclass(frozen=True)
class Config:
    """brand: pattern of the target's name. strong: markup that only the target's own pages hold. competitors: ordered
    (name, pattern); the order is semantic, the first match names the competitor. common: competitors whose names are
    ordinary words. topic, games, extra: words of the trade. ref_suffix, ref_marker, ref_hosts: hosts of the target's
    referral links. Host lists are patterns of whole hosts."""

    brand_name: str = "Acme"
    brand: str = r"(?iU)acme"
    brand_folded: str = r"(?i)acme"
    not_brand: str = r"(?i)acme(tal|tic)"
    strong: str = r"(?i)cdn\.acme\.example"
    shell: str = r"(?i)front\.acme\.example|/acme-spa/"
    mirror_title: str = r"(?i)^\s*acme\.example\b"
    mirror_name: str = r"(?i)\bacme\.example\s*[-–—]"
    competitors: tuple[tuple[str, str], ...] = (("Globex", r"(?iU)globex"), ("Initech", r"(?iU)initech|ini-tech"), ("Umbra", r"(?iU)umbra\s?corp"), ("Hooli", r"(?iU)\bhooli"))
    common: tuple[str, ...] = ("Hooli",)
    stale: tuple[str, ...] = ()
    topic: str = r"(?iU)offer|bonus|deposit|discount|jackpot"
    games: str = r"(?iU)raffle|lottery|wheel of fortune"
    extra: str = r"(?iU)free spins|lucky draw"
    parked: str = r"(?i)domain (name )?(is |may be )?for sale|buy this domain|this domain is parked|domain has expired|site not configured"
    placeholder: str = r"(?i)coming soon|under construction|account (disabled|suspended)|default (web )?page|welcome to nginx"
    geo_block: str = r"(?i)not available in your (country|region|location)|restricted (country|region|territory)|access (is )?(denied|restricted) (from|in) your"
    blocked_title: str = r"(?i)access denied|forbidden|(not available|unavailable) in your (country|region)"
    wall_title: str = r"(?i)just a moment|attention required|checking your browser|verify you are human|access denied|cookie consent|before you continue"
    ref_suffix: str = r"(acm|acme)\.[a-z]+$"
    ref_marker: str = "acme"
    ref_hosts: tuple[str, ...] = ()
    own_refs: tuple[str, ...] = ()
    own_hosts: tuple[str, ...] = ()
    registrar_hosts: str = under(("registrar.example", "parking.example"))
    platform_hosts: str = under(("video.example", "social.example", "store.example"))
    not_ref_hosts: str = under(("short.example", "link.example"))
    not_ad_hosts: str = under((r"consent\.[a-z.]+", "legal.example"))
    not_trade_hosts: str = under(("reviews.example", "helpline.example"))
    noise_hosts: str = under(("metrics.example", "fonts.example"))
    keep_hosts: str = r"(?i)bonus|promo|play|win|lucky|jackpot"
    useful_paths: str = r"(?i)regist|signup|sign-up|login|app|apk|download|bonus|promo|mirror|official"
    script_libraries: str = r"(?i)jquery|wp-includes|gtag|analytics|recaptcha|bootstrap|polyfill|react-dom"
    shorteners: str = under(("short.example",))
    affiliate_params: str = parameters(AFFILIATE_NAMES)
    tracker_params: str = parameters(TRACKER_NAMES)
    code_params: str = parameters(CODE_NAMES)
    brand_params: str = parameters(BRAND_PARAM_NAMES)
    thresholds: Thresholds = field(default_factory=Thresholds)
    #: Families of classes share one calibration.
    families: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("violation", ("mono_other", "mono_mixed", "page_other", "bait", "redirect_other", "discredit", "mono_hidden")),
        ("mono", ("mono_target", "redirect_ref", "mono_xlink", "mono_unresolved", "mono_no_ads", "mirror")),
        ("other", ("multibrand", "article", "hacked", "other_topic", "unrelated", "unclear")),
        ("dead", ("not_shown", "stub", "parked", "dead")),
    )

    def violators(self) -> tuple[str, ...]:
        """The classes that are violations."""
        return dict(self.families).get("violation", ())

    def host_lists(self) -> dict[str, str]:
        """UR18: the named host lists."""
        names = ("registrar", "platform", "not_ref", "not_ad", "not_trade", "noise")
        return {n: getattr(self, f"{n}_hosts") for n in names} | {"shortener": self.shorteners}


DEFAULT = Config()
