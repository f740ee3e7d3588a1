"""Licences: the gate, the three-state verdict, and canonical names from text, markup and payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What tells a restrictive licence, and a commercial one. A restrictive term decides first.
DENY = (
    "non[- ]?commercial", "noncommercial", "nc", "sa", "share[- ]?alike", "gpl", "lgpl", "agpl", "copyleft", "proprietary",
    "all rights reserved", "no licen[sc]e", "need permission", "not for commercial", "commercial use prohibited",
)
ALLOW = (
    "mit", "apache", "bsd", "cc0", "cdla[- ]permissive", "public domain", "us[- ]gov", r"u\.s\. gov", "government work",
    "mitre", "ietf", r"cc[- ]by[- ]?4\.0", "open access", "free for commercial", "commercial use permitted",
    "commercial use allowed", "royalty[- ]free", "free to use", "free of charge", "free for any", "free for all",
    "first[- ]party", "owner[- ]authori[sz]ed", "metadata index", "godl", "government open data license",
)
#: Edges of words, whatever the Java: its \\b is of ASCII words alone in newer versions.
_DENY, _ALLOW = (rf"(?<![\p{{L}}\p{{N}}_])({'|'.join(x)})(?![\p{{L}}\p{{N}}_])" for x in (DENY, ALLOW))


def _plain(raw: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(raw.cast("string"), F.lit(""))), r"[\s\p{Z}]+", " "))


def classify(raw: Column) -> Column:
    """struct(ok, reason): deny before allow, and no by default."""
    s = _plain(raw)
    deny, allow = F.regexp_extract(s, _DENY, 1), F.regexp_extract(s, _ALLOW, 1)
    said = lambda ok, reason: F.struct(F.lit(ok).alias("ok"), reason.alias("reason"))
    return (
        F.when(s == "", said(False, F.lit("missing license")))
        .when(deny != "", said(False, F.concat(F.lit("non-commercial/copyleft license ("), deny, F.lit(")"))))
        .when(allow != "", said(True, F.concat(F.lit("commercial-ok ("), allow, F.lit(")"))))
        .otherwise(said(False, F.concat(F.lit("unrecognized license: '"), raw.cast("string"), F.lit("'"))))
    )


def verdict(raw: Column) -> Column:
    """ok, blocked or unknown."""
    s = _plain(raw)
    return F.when(s.rlike(_DENY), "blocked").when(s.rlike(_ALLOW), "ok").otherwise("unknown")


def gate(raw: Column, enforced: bool = True) -> Column:
    """classify(), or all let through where the gate isn't enforced."""
    passed = F.struct(F.lit(True).alias("ok"), F.lit("gate not enforced").alias("reason"))
    return classify(raw) if enforced else passed


#: A needle in lower-cased text and the canonical name, in order.
NAMES = (
    ("apache", "Apache-2.0"), ("mit", "MIT"), ("bsd-3", "BSD-3-Clause"), ("bsd-2", "BSD-2-Clause"), ("bsd", "BSD"),
    ("agpl", "AGPL-3.0"), ("lgpl", "LGPL-3.0"), ("gpl-2", "GPL-2.0"), ("gplv2", "GPL-2.0"), ("gpl-3", "GPL-3.0"),
    ("gplv3", "GPL-3.0"), ("gpl", "GPL-3.0"), ("mpl", "MPL-2.0"), ("cc0", "CC0-1.0"), ("odbl", "ODbL-1.0"),
    ("openrail", "OpenRAIL"), ("all rights reserved", "All Rights Reserved"), ("public domain", "Public Domain"),
)
#: A stated usage grant and its label, in order; what isn't commercial comes first.
GRANTS = (
    (r"free\s+for\s+non[- ]?commercial", "Non-commercial use only"),
    (r"non[- ]?commercial\s+use\s+only", "Non-commercial use only"),
    (r"not\s+(?:for|permitted\s+for)\s+commercial\s+use", "Non-commercial use only"),
    (r"free\s+for\s+(?:personal\s+and\s+)?commercial\s+use", "Free for commercial use"),
    (r"commercial\s+use\s+(?:is\s+)?(?:permitted|allowed)", "Commercial use permitted"),
    (r"(?:permitted|allowed)\s+for\s+commercial(?:\s+(?:use|purposes?))?", "Commercial use permitted"),
    (r"may\s+be\s+used\s+(?:freely\s+)?for\s+(?:any\s+)?commercial", "Commercial use permitted"),
    (r"royalty[- ]free", "Royalty-free"),
    (r"free\s+of\s+charge", "Free to use"),
    (r"free\s+to\s+use", "Free to use"),
    (r"free\s+for\s+(?:any|all)\s+(?:use|purposes?)", "Free to use"),
    (r"free\s+for\s+public\s+use", "Public use"),
    (r"\bpublic\s+use\b", "Public use"),
)
#: Elements of a Creative Commons licence and the words that name them, in canonical order.
ELEMENTS = (("BY", "attribution"), ("NC", "non-?commercial"), ("SA", "share-?alike"), ("ND", "noderiv"))


def normalized(raw: Column) -> Column:
    """A canonical licence: Creative Commons by address or code, else a known name, else a plausible short id; or empty."""
    s = F.trim(F.coalesce(raw.cast("string"), F.lit("")))
    low = F.lower(s)
    by_url = F.concat(F.lit("CC "), F.upper(F.regexp_extract(low, r"/licenses/([a-z0-9\-]+)/(\d+\.\d+)", 1)), F.lit(" "), F.regexp_extract(low, r"/licenses/([a-z0-9\-]+)/(\d+\.\d+)", 2))
    named = F.array_compact(F.array(*[F.when(low.rlike(words), F.lit(name)) for name, words in ELEMENTS]))
    short = F.split(F.upper(F.regexp_extract(low, r"cc[ \-]?(by(?:[ \-]?(?:nc|sa|nd))*)", 1)), "[ -]+")
    order = F.array(*[F.lit(name) for name, _ in ELEMENTS])
    code = F.array_join(F.when(F.size(named) > 0, named).otherwise(F.array_intersect(order, short)), "-")
    version = F.regexp_extract(low, r"v?(\d\.\d)", 1)
    by_text = F.concat(F.lit("CC "), code, F.lit(" "), F.when(version == "", "4.0").otherwise(version))
    out = F.when(s.rlike(r"^[A-Za-z0-9.\-+ ]{2,40}$") & ~low.contains("noassertion"), s).otherwise("")
    for needle, name in reversed(NAMES):
        out = F.when(low.contains(needle), F.lit(name)).otherwise(out)
    prose = low.contains("creative commons") | low.rlike(r"^cc[ \-]?by") | low.startswith("cc ")
    out = F.when(prose & (code != ""), by_text).when(prose & low.rlike("cc0|zero"), "CC0-1.0").otherwise(out)
    at_cc = low.contains("creativecommons.org")
    out = F.when(at_cc & low.rlike(r"/licenses/[a-z0-9\-]+/\d+\.\d+"), by_url).otherwise(out)
    out = F.when(at_cc & low.contains("publicdomain"), "Public Domain").otherwise(out)
    return F.when(at_cc & low.rlike("publicdomain/zero|/cc0"), "CC0-1.0").otherwise(out)


def grant(text: Column) -> Column:
    """The first usage grant that a text states, or empty."""
    out = F.lit("")
    for pattern, label in reversed(GRANTS):
        out = F.when(text.rlike("(?i)" + pattern), F.lit(label)).otherwise(out)
    return out


def from_html(html: Column) -> Column:
    """By rel=license, JSON-LD, meta, a Creative Commons link, stated grants, all rights reserved; or empty."""
    tag = F.regexp_extract(html, r"""(?is)<(?:a|link)\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*license)[^>]*?\bhref\s*=\s*["']([^"']+)""", 1)
    ld = F.regexp_extract(html, r'(?is)"license"\s*:\s*"([^"]+)"', 1)
    meta = F.regexp_extract(html, r"""(?is)<meta\b(?=[^>]*\bname\s*=\s*["'](?:license|dc\.rights|rights)["'])[^>]*?\bcontent\s*=\s*["']([^"']+)""", 1)
    link = F.regexp_extract(html, r"""(?is)href\s*=\s*["'](https?://creativecommons\.org/[^"']+)""", 1)
    reserved = F.when(html.rlike(r"(?i)all rights reserved"), "All Rights Reserved")
    found = F.coalesce(*[F.nullif(normalized(x), F.lit("")) for x in (tag, ld, meta, link)], F.nullif(grant(html), F.lit("")), reserved)
    return F.coalesce(found, F.lit(""))


def from_payload(payload: Column, kind: str) -> Column:
    """From a host's JSON: `hf` (cardData or tags), `github` (license.spdx_id), `kaggle` (licenseName)."""
    if kind == "github":
        raw = F.coalesce(F.get_json_object(payload, "$.license.spdx_id"), F.get_json_object(payload, "$.license.name"))
    elif kind == "hf":
        raw = F.coalesce(F.get_json_object(payload, "$.cardData.license"), F.nullif(F.regexp_extract(payload, r'"license:([^"]+)"', 1), F.lit("")))
    else:
        raw = F.coalesce(F.get_json_object(payload, "$.licenseName"), F.get_json_object(payload, "$.licenses[0].name"))
    return normalized(raw)
