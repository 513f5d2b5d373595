"""Sources by name; each module has ``parse`` and ``problems`` over landed bodies."""

from tidemark.sources import html_thread, json_feed, rss_feed

REGISTRY = {html_thread.SOURCE: html_thread, rss_feed.SOURCE: rss_feed, json_feed.SOURCE: json_feed}


def enabled(names: list[str]) -> dict:
    """S-01: the named sources, in their own order; unknown names are ignored."""
    return {k: v for k, v in REGISTRY.items() if k in names}
