"""Parameters that queries and their SQL share."""

#: The mixture's whole-number weights; "*" stands for values that are not listed.
MIX_WEIGHTS = {"domain": {"d0": 2, "d1": 3, "d2": 4}, "lang": {"en": 4, "*": 2}}
#: Tokens drawn, as a share of all; passes that a leaf may give; the seed of the passes.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.75, 2, 7

#: Rules of the URL filter: (verdict, host, path). They go before the patterns.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Patterns for URLs that no rule fits: hosts and paths of advertising, trackers, shops of pills, gambling and link farms.
URL_PATTERNS = (
    ("block", "||ads."), ("block", "||ads-track."), ("block", "||adserver."), ("block", "||tracker."), ("block", "||cheap-pills."), ("block", "||casino."), ("block", "||spam-farm."),
    ("block", "/sponsored/"), ("block", "/banners/*/click^"), ("block", "/affiliate^"), ("allow", "/affiliate/terms.html|"),
)
