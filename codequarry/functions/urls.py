"""Fix-commit URLs from reference URLs: one rule for each host, ordered, as one CASE expression.

A rule rewrites a URL by itself, or asks for a page. Pages come as a table links(page, url) of what each page names, and
short links as redirects(url, final), so mining is a join and never a request.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codequarry.session import Scratch


@dataclass(frozen=True)
class Rule:
    host: str
    when: Callable[[Column], Column]
    rewrite: Callable[[Column], Column] | None = None  # None: the page is looked up
    redirect: str = ""  # "short": where the URL names no commit; "always"
    then: Callable[[Column], Column] | None = None  # rewrites what the page names
    again: bool = False  # what the page names goes through the rules once more
    most: int | None = None  # drop the page's links beyond so many


def _sub(*pairs: tuple[str, str]) -> Callable[[Column], Column]:
    def run(u: Column) -> Column:
        for a, b in pairs:
            u = F.replace(u, F.lit(a), F.lit(b))
        return u

    return run


def _has(*parts: str) -> Callable[[Column], Column]:
    def run(u: Column) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | u.contains(p)
        return out

    return run


_any = lambda u: F.lit(True)
SEMICOLON, TO_COMMIT = ("%3B", ";"), ("a=commitdiff", "a=commit")
_gnome = _sub(("http://", "https://"), ("gitlab.gnome.org", "github.com"), ("browse", "GNOME"), ("/-/", "/"))


def _hash_at(u: Column, mark: str = "h=") -> Column:
    return F.substring(u, F.locate(mark, u) + len(mark), F.length(u))


def _to_github(repo: str, *pairs: tuple[str, str]) -> Callable[[Column], Column]:
    return lambda u: F.concat(F.lit(f"https://github.com/{repo}/commit/"), _hash_at(_sub(*pairs)(u)))


# Names of repositories on another server.
CGIT_NAMES = {"xorg/lib/libxpm": "xorg/lib/libXpm", "virgl/virglrenderer": "virglrenderer", "xorg/lib/libx11": "xorg/lib/libX11", "polkit/polkit": "polkit", "libbsd/libbsd": "libbsd", "cairo/cairo": "cairo", "pixman/pixman": "pixman"}


def _kernel(u: Column) -> Column:
    u = _sub(SEMICOLON, ("a=commitdiff_plain", "a=commitdiff"), ("id=", "h="))(u)
    u = F.regexp_replace(u, r"(\w+)-[0-9]\.[\w.]*?\.git", "$1.git")
    return F.when(u.contains("h=") & ~_has("/diff/", "/tree/", "/patch/")(u), u)


def _cgit(u: Column) -> Column:
    u = F.regexp_replace(u, r".diffs\?commit_id.*$", "")
    path = _sub(("/-/", "/"), ("/commit/", "/"))(F.regexp_extract(u, r"^https?://[^/]+(/[^?#]*)", 1))
    repo, commit = F.regexp_extract(path, r"^/(.*)/[^/]*$", 1), F.regexp_extract(path, r"([^/]*)$", 1)
    for a, b in CGIT_NAMES.items():
        repo = F.when(repo == a, F.lit(b)).otherwise(repo)
    return F.concat(F.lit("https://cgit.freedesktop.org/"), repo, F.lit("/commit/?id="), commit)


def _ghostscript(u: Column) -> Column:
    u = _sub(SEMICOLON, TO_COMMIT)(u)
    repo, commit = F.regexp_extract(u, r"[?;]p=([^.;]*)", 1), F.regexp_extract(u, r"[?;]h=([^;]*)", 1)
    return F.when((repo != "") & (commit != ""), F.concat(F.lit("https://github.com/ArtifexSoftware/"), repo, F.lit("/commit/"), commit))


def github(u: Column) -> Column:
    """Without fragment and query; a commit seen within a pull request becomes the commit."""
    plain = F.regexp_replace(u, r"[?#].*$", "")
    return F.regexp_replace(plain, r"^https?://github\.com/([\w-]+/[\w-]+)/pull/\d+/commits/([0-9a-f]+).*$", "https://github.com/$1/commit/$2")


def is_github_commit(u: Column) -> Column:
    return u.rlike(r"^https?://github\.com/[\w-]+/[\w-]+/commit/[0-9a-f]+")


# Hosts and the parts of their URLs, in the order in which the rules are tried.
RULES = [
    Rule("github.com", lambda u: is_github_commit(github(u)), github),
    Rule("github.com", lambda u: github(u).rlike(r"^https?://github\.com/[\w-]+/[\w-]+/(pull|issues)/[0-9a-f]+")),
    Rule("git.kernel.org", _any, _kernel, redirect="short"),
    Rule("sourceware.org", _has("h="), _sub(SEMICOLON)),
    Rule("sourceware.org", _has("sourceware.org/bugzilla/show_bug.cgi")),
    Rule("android.googlesource.com", lambda u: ~u.rlike(r"\.(txt|java|cpp)$"), _sub((",", ""))),
    Rule("xenbits.xen.org", _has("advisory")),
    Rule("code.wireshark.org", _has("h="), _to_github("wireshark/wireshark", SEMICOLON)),
    Rule("codereview.chromium.org", _any),
    Rule("git.videolan.org", _has("h="), _sub(SEMICOLON, TO_COMMIT)),
    Rule("git.moodle.org", _has("a=commit"), _sub(SEMICOLON, TO_COMMIT)),
    Rule("git.moodle.org", _has("a=search")),
    Rule("cgit.freedesktop.org", _has("commit"), lambda u: u),
    Rule("cgit.freedesktop.org", _has("diff"), _sub(("diff", "commit"))),
    Rule("git.gnome.org", lambda u: u != "https://gitlab.gnome.org/users/sign_in", _gnome, redirect="always"),
    Rule("git.openssl.org", _has("commit"), _sub(SEMICOLON, TO_COMMIT)),
    Rule("git.savannah.gnu.org", _has("commit", "patch"), _sub(SEMICOLON, TO_COMMIT, ("a=commit_plain", "a=commit"), ("patch", "commit"))),
    Rule("git.ghostscript.com", _any, _ghostscript),
    Rule("gitlab.gnome.org", lambda u: u.contains("commit") & ~u.rlike(r"\.(c|patch)$"), _gnome),
    Rule("gitlab.gnome.org", lambda u: ~u.rlike(r"\.(c|patch)$"), then=_gnome, most=10),
    Rule("gitlab.freedesktop.org", lambda u: F.regexp_replace(u, r".diffs\?commit_id.*$", "").contains("commit"), _cgit),
    Rule("gitlab.freedesktop.org", _any, then=_cgit, most=10),
    Rule("src.chromium.org", _has("viewvc")),
    Rule("git.qemu.org", _has("commit"), _to_github("qemu/qemu", SEMICOLON, TO_COMMIT, ("id=", "h="), ("gitweb.cgi", ""))),
    Rule("gitlab.com", _has("/commit/"), lambda u: F.regexp_replace(u, r"[?#].*$", "")),
    Rule("gitlab.com", lambda u: _has("/issues/", "/merge_requests/")(u) & ~u.startswith("https://gitlab.com/gitlab-org"), most=10),
    Rule("security-tracker.debian.org", _any, again=True),
    Rule("moodle.org", _has("discuss.php")),
    Rule("bugs.php.net", _has("bug.php")),
    Rule("rustsec.org", _any, again=True),
    Rule("bugzilla.gnome.org", _has("show_bug.cgi")),
    Rule("bugs.ghostscript.com", _has("show_bug.cgi"), again=True),
    Rule("go.dev", _has("issue"), again=True, most=3),
    Rule("git.php.net", _has("commit"), _to_github("php/php-src", SEMICOLON, TO_COMMIT, ("id=", "h="))),
]


def host(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def rule_number(u: Column) -> Column:
    """The first rule for a URL; null where none fits."""
    h = host(u)
    out = F.lit(None).cast("int")
    for i in reversed(range(len(RULES))):
        out = F.when((h == RULES[i].host) & RULES[i].when(u), F.lit(i)).otherwise(out)
    return out


def rewritten(u: Column, rule: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, r in enumerate(RULES):
        if r.rewrite is not None:
            out = F.when(rule == i, r.rewrite(u)).otherwise(out)
    return out


def _rules_where(test: Callable[[Rule], bool]) -> list[int]:
    return [i for i, r in enumerate(RULES) if test(r)]


def mine(references: DataFrame, links: DataFrame | None = None, redirects: DataFrame | None = None) -> DataFrame:
    """(record, url): the different fix-commit URLs of each record's references(record, url).

    links(page, url) has what looked-up pages name, redirects(url, final) where short links lead; without them such
    references give nothing, or stand for themselves. A pull request or issue of a repository is left alone where the
    record names a commit of it. What pages of trackers name is mined again, as far as that leads; a URL is followed
    once for each record, which ends circles.
    """
    scratch = Scratch(references.sparkSession)
    slug = lambda u: F.regexp_extract(github(u), r"^https?://github\.com/([\w-]+/[\w-]+)/", 1)
    now = references.where("url IS NOT NULL").select("record", "url").distinct()
    if links is not None:
        now = scratch.save(now)
    seen, out = [now], None
    while True:
        # a generator keeps the rule from being worked out anew in each of the branches that ask for it
        r = now.select("record", F.inline(F.array(F.struct("url", rule_number(F.col("url")).alias("rule"))))).where("rule IS NOT NULL")
        if redirects is not None:
            short = F.col("rule").isin(_rules_where(lambda x: x.redirect == "always")) | (F.col("rule").isin(_rules_where(lambda x: x.redirect == "short")) & ~F.col("url").contains("commit"))
            r = r.join(redirects.select(F.col("url").alias("_short"), "final"), F.col("url") == F.col("_short"), "left").withColumn("url", F.when(short, F.coalesce("final", "url")).otherwise(F.col("url"))).drop("_short", "final")
        direct = r.select("record", rewritten(F.col("url"), F.col("rule")).alias("url")).where("url IS NOT NULL")
        out = direct if out is None else out.unionByName(direct)
        if links is None:
            break
        pages = r.where(F.col("rule").isin(_rules_where(lambda x: x.rewrite is None)))
        named = r.where(is_github_commit(github(F.col("url")))).select("record", slug(F.col("url")).alias("_slug")).distinct()
        pages = pages.withColumn("_slug", slug(F.col("url"))).join(named, ["record", "_slug"], "left_anti")
        found = pages.join(links.select("page", F.col("url").alias("_to")), F.col("url") == F.col("page"))
        limits = [(i, x.most) for i, x in enumerate(RULES) if x.most is not None]
        many = found.groupBy("record", "page", "rule").agg(F.count_distinct("_to").alias("_n"))
        too_many = F.lit(False)
        for i, k in limits:
            too_many = too_many | ((F.col("rule") == i) & (F.col("_n") > k))
        found = found.join(many.where(~too_many).select("record", "page", "rule"), ["record", "page", "rule"], "left_semi")
        to = F.col("_to")
        for i, x in enumerate(RULES):
            if x.then is not None:
                to = F.when(F.col("rule") == i, x.then(F.col("_to"))).otherwise(to)
        again = F.col("rule").isin(_rules_where(lambda x: x.again))
        out = out.unionByName(found.where(~again).select("record", to.alias("url")))
        next_ = found.where(again).select("record", F.col("_to").alias("url")).distinct().join(reduce(DataFrame.unionByName, seen), ["record", "url"], "left_anti")
        now = scratch.save(next_)
        if now.isEmpty():
            break
        seen.append(now)
    return out.distinct()


def page_links(text: Column) -> Column:
    """The different URLs that a page's text names, in their order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"https?://[^\s\"'<>)\]]+"), F.lit(0)))


def host_frequency(urls: DataFrame, least: int = 50, newest: int = 50) -> DataFrame:
    """(host, n, newest): hosts of more than `least` URLs, with the last `newest` different ones by ordinal; urls has ordinal
    and url. The last of each of 64 parts of a host are kept first, so that no task sees all URLs of a host."""
    h = urls.select(host(F.col("url")).alias("host"), "ordinal", "url")
    n = h.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    per = h.groupBy("host", "url").agg(F.max("ordinal").alias("last")).join(n, "host")
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("last")))
    some = per.withColumn("_part", F.pmod(F.xxhash64("url"), F.lit(64))).withColumn("_r", rank("host", "_part")).where(F.col("_r") <= newest)
    kept = some.withColumn("_r", rank("host")).where(F.col("_r") <= newest)
    return kept.groupBy("host", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("last", "url"))), lambda x: x["url"]).alias("newest"))


#: Code platforms by the form of a commit's URL, first match first.
PLATFORMS = [
    ("github", lambda u: host(u) == "github.com"), ("gitlab", lambda u: u.contains("/-/commit/") | (host(u) == "gitlab.com")), ("gitweb", lambda u: u.rlike(r"[?;]a=commit")),
    ("cgit", lambda u: u.rlike(r"/commit/?\?(id|h)=")), ("gitiles", lambda u: host(u).endswith("googlesource.com")),
]


def platform(u: Column) -> Column:
    out = F.lit("fallback")
    for name, test in reversed(PLATFORMS):
        out = F.when(test(u), F.lit(name)).otherwise(out)
    return out


def commit_hash(u: Column) -> Column:
    """The commit that a URL names; null without one."""
    h = F.coalesce(F.nullif(F.regexp_extract(u, r"[?;&](?:id|h)=([0-9a-f]{7,64})", 1), F.lit("")), F.nullif(F.regexp_extract(u, r"/(?:commit|\+)/([0-9a-f]{7,64})", 1), F.lit("")))
    return h
