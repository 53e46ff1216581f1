"""Browser and operating-system families from user-agent text.

Rules are tried in order; the first match wins. They run inside whole-stage codegen and are only
applied to distinct user agents, never to every event.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
OTHER = "Other"

# Pattern -> family label. Specific products come before the engines they embed.
BROWSER_RULES = [
    (r"(?i)googlebot", "Googlebot"),
    (r"(?i)bingbot", "bingbot"),
    (r"(?i)yandexbot", "YandexBot"),
    (r"HeadlessChrome/", "HeadlessChrome"),
    (r"FBAN/|FBAV/", "Facebook"),
    (r"Instagram", "Instagram"),
    (r"coc_coc_browser/", "Coc Coc"),
    (r"YaBrowser/", "Yandex Browser"),
    (r"Vivaldi/", "Vivaldi"),
    (r"SamsungBrowser/", "Samsung Internet"),
    (r"UCBrowser/|UCWEB", "UC Browser"),
    (r"MiuiBrowser/", "MiuiBrowser"),
    (r"EdgA/|EdgiOS/", "Edge Mobile"),
    (r"Edg/|Edge/", "Edge"),
    (r"Opera Mini/", "Opera Mini"),
    (r"OPR/.*Mobile|Mobile.*OPR/|Opera Mobi", "Opera Mobile"),
    (r"OPR/|^Opera/", "Opera"),
    (r"FxiOS/", "Firefox iOS"),
    (r"(Mobile|Tablet); rv:.*Firefox/", "Firefox Mobile"),
    (r"Firefox/", "Firefox"),
    (r"CriOS/", "Chrome Mobile iOS"),
    (r"Android.*; wv\).*Chrome/", "Chrome Mobile WebView"),
    (r"Chrome/[\d.]+ Mobile|Android.*Chrome/", "Chrome Mobile"),
    (r"Chromium/", "Chromium"),
    (r"Chrome/", "Chrome"),
    (r"MSIE |Trident/", "IE"),
    (r"Android.*Version/[\d.]+.*Safari/", "Android"),
    (r"(iPhone|iPad|iPod).*Version/[\d.]+.*Safari/", "Mobile Safari"),
    (r"(iPhone|iPad|iPod).*AppleWebKit/", "Mobile Safari UI/WKWebView"),
    (r"Version/[\d.]+.*Safari/", "Safari"),
    (r"(?i)^curl/", "curl"),
    (r"(?i)python-requests/", "Python Requests"),
]

OS_RULES = [
    (r"Windows Phone", "Windows Phone"),
    (r"Windows", "Windows"),
    (r"Android", "Android"),
    (r"iPhone|iPad|iPod", "iOS"),
    (r"Mac OS X|Macintosh", "Mac OS X"),
    (r"CrOS", "Chrome OS"),
    (r"Tizen", "Tizen"),
    (r"Ubuntu", "Ubuntu"),
    (r"Fedora", "Fedora"),
    (r"Debian", "Debian"),
    (r"FreeBSD", "FreeBSD"),
    (r"Linux", "Linux"),
]


def _first_match(user_agent: Column, rules: list[tuple[str, str]]) -> Column:
    family = F.when(user_agent.isNull() | (user_agent == ""), F.lit(UNKNOWN))
    for pattern, label in rules:
        family = family.when(user_agent.rlike(pattern), F.lit(label))
    return family.otherwise(F.lit(OTHER))


def browser_family(user_agent: Column) -> Column:
    return _first_match(user_agent, BROWSER_RULES)


def os_family(user_agent: Column) -> Column:
    return _first_match(user_agent, OS_RULES)


def user_agent_families(user_agent: Column) -> Column:
    return F.struct(browser_family(user_agent).alias("browser"), os_family(user_agent).alias("os"))
