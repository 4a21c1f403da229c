"""Queries of URL mining, abstraction, function extraction, flow construction and incremental ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.functions import abstraction, cve, text, urls
from codequarry.graph import cfg
from codequarry.plans.graph_queries import graph_of
from codequarry.plans.step_queries import _pick
from codequarry.session import Scratch, ship, table
from codequarry.sources import records
from codequarry.streaming import ingest


def _github(spark: SparkSession, d: str) -> DataFrame:
    """References of a kind that the miner knows, made from the provided ones."""
    return table(spark, d, "fix_commit").select(F.col("cve_ordinal").alias("record"), F.replace("git_url", F.lit("git.example.org"), F.lit("github.com")).alias("url"), "ordinal")


def text_mined_urls(spark, d):
    refs = _github(spark, d).withColumn("url", F.concat("url", F.when(F.col("ordinal") % 2 == 0, F.lit("?diff=split#top")).otherwise(F.lit(""))))
    return urls.mine(refs)


#: Reference URLs of every kind that is known, made from a commit's hash {h} and ordinal {o}: (references, what looked-up pages
#: name, where short links lead, the URLs that come out). The last part is stated by hand.
G, W = "https://github.com/", "https://"
KINDS: list[tuple[list[str], list[tuple[str, str]], list[tuple[str, str]], list[str]]] = [
    ([G + "a/b/pull/12/commits/{h}?diff=split#x"], [], [], [G + "a/b/commit/{h}"]),
    ([W + "git.kernel.org/?p=linux/torvalds/linux-2.6.git%3Ba=commitdiff_plain%3Bid={h}"], [], [], [W + "git.kernel.org/?p=linux/torvalds/linux.git;a=commitdiff;h={h}"]),
    ([W + "git.kernel.org/linus/{h}/{o}", W + "git.kernel.org/diff/?h={h}"], [], [(W + "git.kernel.org/linus/{h}/{o}", W + "git.kernel.org/c/?id={h}")], [W + "git.kernel.org/c/?h={h}"]),
    ([W + "sourceware.org/git/?p=glibc.git%3Ba=commit%3Bh={h}"], [], [], [W + "sourceware.org/git/?p=glibc.git;a=commit;h={h}"]),
    ([W + "sourceware.org/bugzilla/show_bug.cgi?id={o}"], [(W + "sourceware.org/bugzilla/show_bug.cgi?id={o}", W + "sourceware.org/git/?h={h}")], [], [W + "sourceware.org/git/?h={h}"]),
    ([W + "android.googlesource.com/platform/x/+/{h},", W + "android.googlesource.com/platform/{h}.java"], [], [], [W + "android.googlesource.com/platform/x/+/{h}"]),
    ([W + "xenbits.xen.org/xsa/advisory-{o}.html"], [(W + "xenbits.xen.org/xsa/advisory-{o}.html", W + "xenbits.xen.org/gitweb/?h={h}")], [], [W + "xenbits.xen.org/gitweb/?h={h}"]),
    ([W + "code.wireshark.org/review/gitweb?p=wireshark.git%3Ba=commit%3Bh={h}"], [], [], [G + "wireshark/wireshark/commit/{h}"]),
    ([W + "codereview.chromium.org/{o}"], [(W + "codereview.chromium.org/{o}", W + "chromium.googlesource.com/src/+/{h}")], [], [W + "chromium.googlesource.com/src/+/{h}"]),
    ([W + "git.videolan.org/?p=vlc.git%3Ba=commitdiff%3Bh={h}", W + "git.videolan.org/?p=vlc.git"], [], [], [W + "git.videolan.org/?p=vlc.git;a=commit;h={h}"]),
    ([W + "git.moodle.org/gw?p=moodle.git%3Ba=commitdiff%3Bh={h}"], [], [], [W + "git.moodle.org/gw?p=moodle.git;a=commit;h={h}"]),
    ([W + "git.moodle.org/gw?p=moodle.git&a=search&s=MDL-{o}"], [(W + "git.moodle.org/gw?p=moodle.git&a=search&s=MDL-{o}", W + "git.moodle.org/gw?h={h}")], [], [W + "git.moodle.org/gw?h={h}"]),
    ([W + "cgit.freedesktop.org/x/commit/?id={h}", W + "cgit.freedesktop.org/y/diff/?id={h}", W + "cgit.freedesktop.org/z/log"], [], [], [W + "cgit.freedesktop.org/x/commit/?id={h}", W + "cgit.freedesktop.org/y/commit/?id={h}"]),
    ([W + "git.gnome.org/browse/x/commit/?id={h}&o={o}"], [], [(W + "git.gnome.org/browse/x/commit/?id={h}&o={o}", "http://gitlab.gnome.org/browse/x/-/commit/{h}")], [G + "GNOME/x/commit/{h}"]),
    ([W + "git.openssl.org/?p=openssl.git%3Ba=commitdiff%3Bh={h}"], [], [], [W + "git.openssl.org/?p=openssl.git;a=commit;h={h}"]),
    ([W + "git.savannah.gnu.org/cgit/x.git/patch/?id={h}", W + "git.savannah.gnu.org/gitweb/?p=y.git%3Ba=commit_plain%3Bh={h}"], [], [], [W + "git.savannah.gnu.org/cgit/x.git/commit/?id={h}", W + "git.savannah.gnu.org/gitweb/?p=y.git;a=commit;h={h}"]),
    (["http://git.ghostscript.com/?p=mupdf.git%3Ba=commitdiff%3Bh={h}"], [], [], [G + "ArtifexSoftware/mupdf/commit/{h}"]),
    ([W + "gitlab.gnome.org/GNOME/libxml2/-/commit/{h}", W + "gitlab.gnome.org/GNOME/x/-/commit/{h}.patch"], [], [], [G + "GNOME/libxml2/commit/{h}"]),
    ([W + "gitlab.gnome.org/GNOME/x/issues/{o}"], [(W + "gitlab.gnome.org/GNOME/x/issues/{o}", W + "gitlab.gnome.org/GNOME/x/-/commit/{h}")], [], [G + "GNOME/x/commit/{h}"]),
    ([W + "gitlab.freedesktop.org/xorg/lib/libxpm/-/commit/{h}"], [], [], [W + "cgit.freedesktop.org/xorg/lib/libXpm/commit/?id={h}"]),
    ([W + "gitlab.freedesktop.org/a/b/issues/{o}"], [(W + "gitlab.freedesktop.org/a/b/issues/{o}", W + "gitlab.freedesktop.org/polkit/polkit/-/commit/{h}")], [], [W + "cgit.freedesktop.org/polkit/commit/?id={h}"]),
    ([W + "src.chromium.org/viewvc/blink?revision={o}"], [(W + "src.chromium.org/viewvc/blink?revision={o}", W + "chromium.googlesource.com/blink/+/{h}")], [], [W + "chromium.googlesource.com/blink/+/{h}"]),
    ([W + "git.qemu.org/gitweb.cgi?p=qemu.git%3Ba=commitdiff%3Bid={h}"], [], [], [G + "qemu/qemu/commit/{h}"]),
    ([W + "gitlab.com/a/b/-/commit/{h}?merge=1#n"], [], [], [W + "gitlab.com/a/b/-/commit/{h}"]),
    ([W + "gitlab.com/a/b/issues/{o}", W + "gitlab.com/gitlab-org/b/issues/{o}"], [(W + "gitlab.com/a/b/issues/{o}", W + "gitlab.com/a/b/-/commit/{h}"), (W + "gitlab.com/gitlab-org/b/issues/{o}", W + "gitlab.com/no")], [], [W + "gitlab.com/a/b/-/commit/{h}"]),
    ([W + "security-tracker.debian.org/tracker/{o}"], [(W + "security-tracker.debian.org/tracker/{o}", W + "git.openssl.org/?a=commitdiff;h={h}")], [], [W + "git.openssl.org/?a=commit;h={h}"]),
    ([W + "moodle.org/mod/forum/discuss.php?d={o}"], [(W + "moodle.org/mod/forum/discuss.php?d={o}", W + "git.moodle.org/gw?a=commit;h={h}")], [], [W + "git.moodle.org/gw?a=commit;h={h}"]),
    ([W + "bugs.php.net/bug.php?id={o}"], [(W + "bugs.php.net/bug.php?id={o}", G + "php/php-src/commit/{h}")], [], [G + "php/php-src/commit/{h}"]),
    ([W + "rustsec.org/advisories/{o}"], [(W + "rustsec.org/advisories/{o}", W + "security-tracker.debian.org/rust/{o}"), (W + "security-tracker.debian.org/rust/{o}", W + "rustsec.org/more/{o}"), (W + "rustsec.org/more/{o}", W + "security-tracker.debian.org/last/{o}"),
      (W + "security-tracker.debian.org/last/{o}", G + "r/s/commit/{h}"), (W + "security-tracker.debian.org/last/{o}", W + "rustsec.org/advisories/{o}")], [], [G + "r/s/commit/{h}"]),
    ([W + "bugzilla.gnome.org/show_bug.cgi?id={o}"], [(W + "bugzilla.gnome.org/show_bug.cgi?id={o}", G + "GNOME/y/commit/{h}")], [], [G + "GNOME/y/commit/{h}"]),
    ([W + "bugs.ghostscript.com/show_bug.cgi?id={o}"], [(W + "bugs.ghostscript.com/show_bug.cgi?id={o}", "http://git.ghostscript.com/?p=jbig.git;h={h}")], [], [G + "ArtifexSoftware/jbig/commit/{h}"]),
    ([W + "go.dev/issue/{o}"], [(W + "go.dev/issue/{o}", G + "golang/go/commit/{h}")], [], [G + "golang/go/commit/{h}"]),
    ([W + "go.dev/issue/many/{o}"], [(W + "go.dev/issue/many/{o}", G + f"golang/go/commit/{i}{{h}}") for i in range(4)], [], []),
    ([W + "git.php.net/?p=php-src.git%3Ba=commit%3Bh={h}"], [], [], [G + "php/php-src/commit/{h}"]),
    ([G + "p/q/issues/{o}", G + "p/q/commit/{h}"], [(G + "p/q/issues/{o}", G + "p/q/commit/1{h}")], [], [G + "p/q/commit/{h}"]),
    ([G + "p/q/pull/{o}", G + "other/q/commit/{h}"], [(G + "p/q/pull/{o}", G + "p/q/commit/1{h}")], [], [G + "other/q/commit/{h}", G + "p/q/commit/1{h}"]),
    ([W + "git.example.org/a/commit/{h}"], [], [], []),
]


def text_mined_hosts(spark, d):
    """References of every kind of host, a kind for each commit."""
    c = table(spark, d, "fix_commit").where("commit_hash IS NOT NULL").select("ordinal", F.col("commit_hash").alias("h"), (F.col("ordinal") % len(KINDS)).alias("kind"))

    def made(part) -> DataFrame:
        rows = [(k, *((x,) if isinstance(x, str) else x)) for k, kind in enumerate(KINDS) for x in part(kind)]
        t = spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None) for r in rows], "kind long, a string, b string")  # a row for each kind
        fill = lambda x: F.replace(F.replace(F.col(x), F.lit("{h}"), F.col("h")), F.lit("{o}"), F.col("ordinal").cast("string"))
        return c.join(F.broadcast(t), "kind").select("ordinal", fill("a").alias("a"), fill("b").alias("b"))

    refs = made(lambda k: k[0]).select(F.col("ordinal").alias("record"), F.col("a").alias("url"))
    return urls.mine(refs, made(lambda k: k[1]).select(F.col("a").alias("page"), F.col("b").alias("url")), made(lambda k: k[2]).select(F.col("a").alias("url"), F.col("b").alias("final")))


def text_redirects(spark, d):
    """Chains that lead from each commit to the one before, to a repository's first; a circle in some."""
    c = table(spark, d, "fix_commit").select("ordinal")
    name = lambda x: F.concat(F.lit("https://s/"), x.cast("string"))
    o = F.col("ordinal")
    hops = c.where("ordinal % 50 <> 1").select(name(o).alias("url"), name(o - 1).alias("final")).unionByName(c.where("ordinal % 200 = 1").select(name(o).alias("url"), name(o + 5).alias("final")))
    return records.resolve_redirects(c.select(name(o).alias("url")), hops)


#: Parts of raw records by ordinal; what comes of each is stated in the SQL.
RAW = {
    "vulnStatus": ['"Analyzed"', '"Modified"', '"Rejected"', '"Analyzed"', '"Modified"'],
    "descriptions": ['[{"lang":"en","value":"one"}]', '[{"lang":"es","value":"x"},{"lang":"en","value":"two"}]', '[{"lang":"es","value":"x"}]', '[{"lang":"en","value":"first"},{"lang":"en","value":"second"}]'],
    "metrics": [
        '{"cvssMetricV2":[{"type":"Secondary","baseSeverity":"LOW","cvssData":{"vectorString":"v1","baseScore":1.0}},{"type":"Primary","baseSeverity":"HIGH","cvssData":{"vectorString":"v2","baseScore":7.5}}]}',
        '{"cvssMetricV31":[{"type":"Primary","cvssData":{"vectorString":"w1","baseScore":2.0,"baseSeverity":"LOW"}},{"type":"Primary","cvssData":{"vectorString":"w2","baseScore":9.8,"baseSeverity":"CRITICAL"}}]}',
        '{"cvssMetricV2":[{"type":"Primary","baseSeverity":"MEDIUM","cvssData":{"vectorString":"v3","baseScore":5.0}}],"cvssMetricV31":[{"type":"Primary","cvssData":{"vectorString":"w3","baseScore":9.0,"baseSeverity":"CRITICAL"}}]}',
        '{}',
        '{"cvssMetricV31":[{"type":"Secondary","cvssData":{"vectorString":"w4","baseScore":3.1,"baseSeverity":"LOW"}}]}',
        '{"cvssMetricV2":[{"type":"Secondary","baseSeverity":"LOW","cvssData":{"vectorString":"v5","baseScore":1.2}},{"type":"Secondary","baseSeverity":"HIGH","cvssData":{"vectorString":"v6","baseScore":8.0}}]}',
    ],
    "weaknesses": [
        '[{"type":"Primary","description":[{"lang":"en","value":"CWE-79"},{"lang":"en","value":"CWE-20"}]}]', '[{"type":"Primary","description":[{"lang":"en","value":"NVD-CWE-noinfo"}]},{"type":"Secondary","description":[{"lang":"en","value":"CWE-22"}]}]',
        '[{"type":"Primary","description":[{"lang":"en","value":"NVD-CWE-Other"}]}]', 'null', '[]', '[{"type":"Secondary","description":[{"lang":"en","value":"CWE-1"},{"lang":"es","value":"CWE-2"}]}]',
        '[{"type":"Primary","description":[{"lang":"en","value":"CWE-9"},{"lang":"en","value":"CWE-9"},{"lang":"en","value":"NVD-CWE-Other"}]}]',
    ],
    "references": ['[{"url":"a"},{"url":"a"},{"url":"b"}]', '[]', '[{"url":"c"}]'],
}


def text_raw_records(spark, d):
    """Raw records of every form, one for each CVE."""
    parts = ", ".join(f"'\"{k}\":', {_pick(v, f'ordinal % {len(v)}', True)}, ','" for k, v in RAW.items())
    j = F.expr(f"concat('{{', {parts}, '\"id\":\"', cve_id, '-', ordinal, '\",\"published\":\"p\",\"lastModified\":\"m\"}}')")
    raw = table(spark, d, "cve").select(F.from_json(j, cve.RAW_SCHEMA).alias("r")).select("r.*")
    return cve.records(raw).select("cve_id", "description", F.col("cvss.vector").alias("vector"), F.col("cvss.base_score").alias("score"), F.col("cvss.base_severity").alias("severity"), F.col("cvss.is_v3").alias("is_v3"), F.array_join("cwe_ids", ",").alias("cwes"), F.array_join("urls", ",").alias("urls"))


def text_platforms(spark, d):
    u = table(spark, d, "fix_commit").where("git_url IS NOT NULL").unionByName(_github(spark, d).select(F.col("url").alias("git_url")).where("git_url IS NOT NULL"), allowMissingColumns=True)
    return u.groupBy(urls.platform(F.col("git_url")).alias("platform")).agg(F.count(F.lit(1)).alias("n"))


def text_commit_hashes(spark, d):
    return table(spark, d, "fix_commit").select("ordinal", urls.commit_hash(F.col("git_url")).alias("hash"))


def text_host_frequency(spark, d):
    return urls.host_frequency(table(spark, d, "fix_commit").where("git_url IS NOT NULL").select("ordinal", F.col("git_url").alias("url")), 5, 3).select("host", "n", F.array_join("newest", " ").alias("newest"))


def text_abstracted(spark, d):
    """Symbols of each function's text."""
    out = table(spark, d, "func").where("func IS NOT NULL").select("ordinal", abstraction.abstracted(F.col("func")).alias("a"))
    return out.select("ordinal", F.length("a.code").alias("chars"), F.size(F.map_keys("a.symbols")).alias("n_types"))


def text_functions(spark, d):
    """Functions found in each function's text: there should be one."""
    return abstraction.extract_functions(table(spark, d, "func").select("ordinal", "func"), "ordinal", "func").select("ordinal", "position", "func_name", "signature", "first_line", "last_line")


def text_without_comments(spark, d):
    f = table(spark, d, "func").where("func IS NOT NULL")
    return f.select("ordinal", F.length(text.blank_comments(F.col("func"))).alias("chars"))


def text_languages(spark, d):
    return records.language_of(table(spark, d, "commit_file"), "commit_ordinal", "file_path")


def graph_built_flow(spark, d):
    """Control flow made anew from the syntax trees."""
    return cfg.control_flow(graph_of(spark, d)).select("graph_id", "src", "dst")


def stream_commits(spark, d):
    """Commits ingested as a stream, each hash once."""
    ship(spark)
    scratch = Scratch(spark)
    src = table(spark, d, "fix_commit").select("ordinal", "commit_hash", F.col("crawled_at").cast("timestamp").alias("crawled_at")).where("commit_hash IS NOT NULL AND crawled_at IS NOT NULL")
    landed = f"{scratch.root}/landing"
    src.write.parquet(landed)
    stream = ingest.new_records(spark, landed, src.schema, ["commit_hash"], "crawled_at", "36500 days")
    ingest.run_available(stream, f"{scratch.root}/out", f"{scratch.root}/state")
    return spark.read.schema(src.schema).parquet(f"{scratch.root}/out").select("commit_hash")


def queries() -> dict:
    return {f.__name__: f for f in (text_raw_records, text_mined_urls, text_mined_hosts, text_redirects, text_platforms, text_commit_hashes, text_host_frequency, text_abstracted, text_functions, text_without_comments, text_languages, graph_built_flow, stream_commits)}


def oracle_sql() -> dict[str, str]:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    mined = " UNION ALL ".join(f"SELECT ordinal AS record, replace({quoted(u)}, '{{h}}', commit_hash) AS url FROM fix_commit WHERE commit_hash IS NOT NULL AND ordinal % {len(KINDS)} = {k}" for k, kind in enumerate(KINDS) for u in kind[3])
    return {
        "text_raw_records": """SELECT cve_id || '-' || ordinal AS cve_id, ['one', 'two', '', 'first'][ordinal % 4 + 1] AS description, ['v2', 'w2', 'v3', NULL, 'w4', 'v5'][ordinal % 6 + 1] AS vector,
            [7.5, 9.8, 5.0, NULL, 3.1, 1.2][ordinal % 6 + 1]::DOUBLE AS score, ['HIGH', 'CRITICAL', 'MEDIUM', NULL, 'LOW', 'LOW'][ordinal % 6 + 1] AS severity, [false, true, false, NULL, true, false][ordinal % 6 + 1] AS is_v3,
            ['CWE-20,CWE-79', 'CWE-22', 'CWE-Other', NULL, NULL, 'CWE-1', 'CWE-9'][ordinal % 7 + 1] AS cwes, ['a,b', NULL, 'c'][ordinal % 3 + 1] AS urls
            FROM cve WHERE ordinal % 5 <> 2 AND ordinal % 7 NOT IN (3, 4) AND ordinal % 3 <> 1""",
        "text_mined_hosts": mined,
        # of the circles from 1 to 6, 201 to 206 ... only what leads into them, up to 50, stands for itself
        "text_redirects": """SELECT 'https://s/' || ordinal AS url, 'https://s/' || CASE WHEN (ordinal - 1) % 200 < 50 AND (ordinal - 1) - (ordinal - 1) % 200 + 6 <= (SELECT max(ordinal) FROM fix_commit) THEN ordinal ELSE ordinal - (ordinal - 1) % 50 END AS final FROM fix_commit""",
        "text_mined_urls": "SELECT DISTINCT cve_ordinal AS record, replace(git_url, 'git.example.org', 'github.com') AS url FROM fix_commit WHERE git_url IS NOT NULL AND regexp_matches(git_url, '^https?://[^/]+/[A-Za-z0-9_-]+/[A-Za-z0-9_-]+/commit/[0-9a-f]+')",
        "text_platforms": "SELECT platform, count(*) AS n FROM (SELECT 'fallback' AS platform FROM fix_commit WHERE git_url IS NOT NULL UNION ALL SELECT 'github' FROM fix_commit WHERE git_url IS NOT NULL) GROUP BY 1",
        "text_commit_hashes": "SELECT ordinal, nullif(regexp_extract(git_url, '/commit/([0-9a-f]{7,64})', 1), '') AS hash FROM fix_commit",
        "text_host_frequency": """WITH u AS (SELECT regexp_extract(git_url, '://([^/]+)', 1) AS host, git_url, ordinal FROM fix_commit WHERE git_url IS NOT NULL), n AS (SELECT host, count(*) AS n FROM u GROUP BY 1 HAVING n > 5),
            p AS (SELECT host, git_url, max(ordinal) AS last FROM u GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY last DESC) AS rn FROM p)
            SELECT host, n, (SELECT string_agg(git_url, ' ' ORDER BY last) FROM r WHERE r.host = n.host AND rn <= 3) AS newest FROM n""",
        "text_without_comments": "SELECT ordinal, length(func)::INTEGER AS chars FROM func WHERE func IS NOT NULL",
        "text_languages": """SELECT commit_ordinal, arg_min(l, (-n, l)) AS language FROM (SELECT commit_ordinal, CASE WHEN lower(file_path) LIKE '%.java' THEN 'java' ELSE 'c' END AS l, count(*) AS n FROM commit_file
            WHERE regexp_matches(lower(file_path), '\\.(c|h|cc|cpp|cxx|hpp|java)$') GROUP BY 1, 2) GROUP BY 1""",
        "stream_commits": "SELECT DISTINCT commit_hash FROM fix_commit WHERE commit_hash IS NOT NULL AND crawled_at IS NOT NULL",
    }
