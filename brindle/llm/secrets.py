"""Secret scans with a random forest that removes false positives.

Candidates are long runs of token characters, private-key blocks, shorter values directly after a secret name, and
passwords in URLs.  Length,
character transitions, digit and hex shares, dictionary coverage, path marks and
the words within 48 characters on either side, other candidates included, describe each one.  A forest grown from labelled findings judges
them; its trees are compiled into one SQL expression, so scanning is a single projection of
built-in expressions without any shuffle.

The labelled findings are made by rule from a fixed seed (``labelled_findings``) or passed in
by the caller as rows (left, value, right, y), for example read from JSON lines by ``load_findings``.  The driver
grows the forest from at most ``FINDINGS`` of them, by the features that the same expressions compute.

Defined results: null and empty texts have no candidates and stay as they are; repeated
rows are scanned one by one; texts are never cut; spans are code points, end exclusive; columns of the input may have any names.
"""

from __future__ import annotations

import base64
import json
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

#: From a BEGIN line to the END line before any other BEGIN or END: headers, BLOCK forms and any length (possessive, so no recursion).
KEY_BLOCK = r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
CANDIDATE = KEY_BLOCK + r"|[A-Za-z0-9+/_.~-]{16,}+={0,2}"
#: Values of any length directly after a secret name, in quotes or up to a blank; the first look back is the cheap one.
AFTER_NAME = (
    r"(?<=[=:\s\"'`])(?<=[=:]\s{0,2}[\"'`]?)"
    r"(?<=(?i:token|secret|key|passwd|password|passphrase|pwd|auth|bearer|credentials?)[A-Za-z0-9_-]{0,24}[\"'`]?\s{0,2}[=:]\s{0,2}[\"'`]?)"
    r"[^\s\"'`,;<>=:][^\s\"'`,;<>]{3,}+"
)
#: What stands between the user's name and the host in a URL.
IN_URL = r"(?<=:)(?<=://[^\s/:@]{1,255}:)[^\s/@]{3,}+(?=@)"
SCANNED = CANDIDATE + "|" + IN_URL + "|" + AFTER_NAME
MASK = "<secret>"
NEAR = 48

#: Words that identifiers, paths, placeholders and prose are made of, and some frequent word endings.
DICTIONARY = (
    "password passwd passphrase secret token credential example sample dummy placeholder changeme your here test user admin root guest "
    "version index image static release build number snapshot branch commit master main head tag "
    "http https www com org net html xhtml json yaml xml csv data file files path paths home usr lib var etc opt src docs doc bin tmp "
    "api client server service host port local remote config default value name node module package import export class object type "
    "string integer null none true false required hidden public private protected function return method field table column row key "
    "report document section chapter page article archive download upload content message request response session cache account "
    "about after again also another because before being between both could does down each even every first found from great hand have "
    "into just know large last like line little live long look made make many more most must name never next only other over part "
    "people place point right same should show small some sound still such take than that their them then there these they thing "
    "think this those three through time under very water well were what when where which while white will with word work world "
    "would write year and the for not you all can had her was one our out day get has him his how man new now old see two way who "
    "tion ness ment able ing ity ence ance ous ful less ship heit keit ung schaft lich mente aciones eur aux"
).split()
SECRET_NAMES = r"(?i)(token|secret|api[_-]?key|apikey|passw|pwd|auth|bearer|credential|private[_-]?key|access[_-]?key|\bkey)"
HASH_NAMES = r"(?i)(commit|sha-?1|sha-?256|md5|checksum|digest|uuid|guid|revision|integrity|etag|hash|fingerprint|example|sample)"
#: Names that are candidates themselves.
LONG_NAMES = ("AWS_SECRET_ACCESS_KEY", "aws_secret_access_key", "GITHUB_ACCESS_TOKEN", "database_password", "STRIPE_SECRET_API_KEY", "oauth_client_secret", "service-account-private-key")
#: Findings that a forest is grown from, at most.
FINDINGS = 20000
KNOWN = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_|xox[abprs]-|sk-|sk_live_|glpat-|AIza|eyJ|-----BEGIN)"


def features(left: Column, value: Column, right: Column) -> Column:
    """The description of a candidate as a struct of doubles."""
    n = F.length(value)
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    yes = lambda x: F.when(x, F.lit(1.0)).otherwise(F.lit(0.0))
    words = "(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))
    covered = (n - F.length(F.regexp_replace(value, words, ""))) / n
    cols = {
        "length": n.cast("double"),
        "transitions": share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])"),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "hexadecimal": yes(value.rlike("^[0-9a-fA-F]+$")),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(32)),
        "dictionary": covered,
        "vowels": share("(?i)[aeiou]"),
        "marks": share("[/._~-]"),
        "path": yes(value.rlike("/[^/]+/|\\.[a-z]{2,4}$") | left.rlike("(://|/|@)[^ ]{0,20}$")),
        "assigned": yes(left.rlike("[=:]\\s{0,2}[\"'`]?$")),
        "secret_name": yes(left.rlike(SECRET_NAMES)),
        "named": yes(left.rlike(SECRET_NAMES + "[A-Za-z0-9_-]{0,24}[\"'`]?\\s{0,2}[=:]\\s{0,2}[\"'`]?$")),
        "hash_name": yes(left.rlike(HASH_NAMES) | right.rlike(HASH_NAMES)),
        "known": yes(value.rlike(KNOWN)),
        "in_url": yes(left.rlike("://[^\\s/:@]+:$") & right.startswith("@")),
    }
    return F.struct(*[c.alias(k) for k, c in cols.items()])


NAMES = ("length", "transitions", "digits", "upper", "hexadecimal", "distinct", "dictionary", "vowels", "marks", "path", "assigned", "secret_name", "named", "hash_name", "known", "in_url")


def labelled_findings(n: int = 2400, seed: int = 11) -> list[dict]:
    """Findings with their labels, made by rule: credentials of usual forms, and what is mistaken for them."""
    r = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pieces = "the and ing tion er on an re ed nd ha en to it or es st ar te is ou at he th in un der ein ich lich heit keit sch ge ver zu be de la que ment aux eur ción mente ado los".split()
    word = lambda k: "".join(r.choice(pieces) for _ in range(k)).encode("ascii", "ignore").decode()
    prose = lambda: " ".join(word(r.randint(1, 3)) for _ in range(r.randint(0, 6)))
    pick = lambda chars, k: "".join(r.choice(chars) for _ in range(k))
    out = []
    for i in range(n):
        before, after = prose(), prose()
        if r.random() < 0.2:  # a finding close by, which is none of this one's business
            before = r.choice(["token", "password", *LONG_NAMES, "commit", "sha256"]) + r.choice(["=", ": ", ' = "']) + pick(alnum, r.randint(16, 30)) + r.choice([" ", "\n", '" ', ", "]) + before
        elif r.random() < 0.1:
            before += " " + word(2) + "." + str(r.randint(1, 99)) + "@mail.example.com " + word(1)
        if i % 2:
            name = r.choice(["token", "secret", "api_key", "password", "auth_token", "access_key", "AWS_SECRET", "client_secret", "key", "bearer", *LONG_NAMES])
            value = r.choice([
                lambda: pick("0123456789abcdef", r.choice([32, 40, 64])),
                lambda: pick(alnum, r.randint(20, 60)),
                lambda: base64.b64encode(r.randbytes(r.choice([18, 24, 30, 48]))).decode(),
                lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
                lambda: "".join(r.sample(pick(alnum, 6) + pick("0123456789", 3) + pick("!#$%&*+?@^_-", 2), r.randint(7, 11))),
                lambda: r.choice(["ghp_", "sk-", "xoxb-", "glpat-"]) + pick(alnum, r.randint(20, 40)),
            ])()
            if r.random() < 0.12:
                kind = r.choice(["RSA PRIVATE KEY", "EC PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "PGP PRIVATE KEY BLOCK"])
                head = r.choice(["", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + pick("0123456789ABCDEF", 32) + "\n\n", "Version: GnuPG v2\n\n"])
                lines = "\n".join(pick(alnum + "+/", 64) for _ in range(r.randint(1, 24)))
                out.append({"left": before[-NEAR:], "value": f"-----BEGIN {kind}-----\n{head}{lines}\n-----END {kind}-----", "right": after[:NEAR], "y": 1})
                continue
            if r.random() < 0.08:
                scheme = r.choice(["postgres", "mysql", "mongodb", "redis", "amqp", "https", "ftp"])
                out.append({"left": f"{before} {scheme}://{word(1)}:"[-NEAR:], "value": r.choice([value, pick(alnum, r.randint(5, 14)), word(2) + pick("0123456789!", 3)]).replace("@", "").replace("/", ""), "right": f"@{word(2)}.example.com/{word(1)} {after}"[:NEAR], "y": 1})
                continue
            if r.random() < 0.85 or not value.startswith(("AKIA", "ghp_", "sk-", "xoxb-", "glpat-")):
                before += " " + name + r.choice([" = ", "=", ": ", ' = "', "='", ":", ' "'])
            out.append({"left": before[-NEAR:], "value": value, "right": after[:NEAR], "y": 1})
        else:
            value, name = r.choice([
                lambda: (word(r.randint(6, 14)), ""),
                lambda: (word(r.randint(6, 14)), r.choice(["", "token = ", "key: ", "password "])),
                lambda: ("-".join(word(2) for _ in range(r.randint(4, 8))), ""),
                lambda: ("/".join(word(2) for _ in range(r.randint(3, 7))) + r.choice(["", ".html", ".py", "/"]), r.choice(["", "path: ", "see "])),
                lambda: ("www." + word(2) + ".example.com/" + word(3), r.choice(["", "https://"])),
                lambda: (pick("0123456789abcdef", r.choice([32, 40, 64])), r.choice(["commit ", "sha256: ", "md5 = ", "checksum ", "revision ", "digest: sha256:"])),
                lambda: ("-".join(pick("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), r.choice(["uuid ", "guid: ", "id ", ""])),
                lambda: (r.choice(["your_api_key_here", "example_token_placeholder", "changeme_changeme", "dummy-secret-value-here", "test_password_example"]), "token = "),
                lambda: (pick("0123456789", r.randint(16, 22)), ""),
                lambda: (r.choice("-_.x*0") * r.randint(16, 60), r.choice(["", "token = ", "password: "])),
                lambda: (".".join(str(r.randint(0, 99)) for _ in range(7)) + "-SNAPSHOT", "version "),
                lambda: (r.choice(LONG_NAMES) + r.choice(["", "="]), ""),
                lambda: (word(r.randint(2, 5)), r.choice(["token: ", "key: ", "password: ", "secret = ", "auth: ", "key=", 'password = "'])),
                lambda: (r.choice(["string", "None", "null", "true", "false", "required", "hidden", "value", "example", "changeme", "os.environ", "config.key", "12345"]), r.choice(["token: ", "key: ", "password: ", "secret = ", "key=", 'password = "'])),
                lambda: (word(2) + "." + str(r.randint(1, 99)) + "@mail.example.com".replace("@", "."), ""),
                lambda: (r.choice(["8080", "5432/" + word(1), "443", "password", "xxxx"]), r.choice(["http://localhost:", "https://" + word(2) + ".example.com:"])),
            ])()
            out.append({"left": (before + " " + name)[-NEAR:], "value": value + "x" * max(0, 16 - len(value)) if not name else value, "right": after[:NEAR], "y": 0})
    return out


def grow(x, y, trees: int = 15, depth: int = 6, seed: int = 5) -> list:
    """A random forest of (feature, bound, left, right) nodes and leaf probabilities."""
    import numpy as np

    r = np.random.default_rng(seed)
    tries = max(2, int(x.shape[1] ** 0.5) + 1)

    def node(rows, d: int):
        p = float(y[rows].mean())
        if d == 0 or p in (0.0, 1.0) or len(rows) < 8:
            return round((y[rows].sum() + 0.5) / (len(rows) + 1), 4)
        best = (1e9, -1, 0.0)
        for f in r.choice(x.shape[1], tries, replace=False):
            v = x[rows, f]
            order = np.argsort(v, kind="stable")
            s, t = v[order], y[rows][order]
            ones = np.cumsum(t)[:-1]
            k = np.arange(1, len(t))
            q1, q2 = ones / k, (t.sum() - ones) / (len(t) - k)
            cost = np.where(s[1:] > s[:-1], k * q1 * (1 - q1) + (len(t) - k) * q2 * (1 - q2), 1e9)
            j = int(cost.argmin())
            if cost[j] < best[0]:
                best = (float(cost[j]), int(f), float((s[j] + s[j + 1]) / 2))
        if best[1] < 0:
            return round((y[rows].sum() + 0.5) / (len(rows) + 1), 4)
        low = x[rows, best[1]] <= best[2]
        return (best[1], best[2], node(rows[low], d - 1), node(rows[~low], d - 1))

    return [node(r.integers(0, len(y), len(y)), depth) for _ in range(trees)]


def compile_forest(forest: list, record: Column) -> Column:
    """The mean of the trees' probabilities as one expression over the feature struct."""

    def tree(t) -> Column:
        return F.lit(float(t)) if not isinstance(t, tuple) else F.when(record[NAMES[t[0]]] <= t[1], tree(t[2])).otherwise(tree(t[3]))

    out = tree(forest[0])
    for t in forest[1:]:
        out = out + tree(t)
    return out / len(forest)


def load_findings(spark: SparkSession, path: str) -> list[dict]:
    """Labelled findings from JSON lines (left, value, right, y); the first ``FINDINGS`` by hash, nulls as empty texts."""
    rows = spark.read.schema("left string, value string, right string, y int").json(path).where("y IN (0, 1) AND value <> ''")
    drawn = rows.orderBy(F.xxhash64("left", "value", "right"), "left", "value", "right").limit(FINDINGS)
    return [{k: r[k] or "" for k in ("left", "value", "right")} | {"y": r["y"]} for r in drawn.collect()]


def train(spark: SparkSession, findings: list[dict] | None = None) -> list:
    import numpy as np

    rows = findings if findings is not None else labelled_findings()
    if len(rows) > FINDINGS:
        raise ValueError(f"at most {FINDINGS} findings; draw a sample")
    literal = F.from_json(F.lit(json.dumps(rows)), "array<struct<left:string,value:string,right:string,y:int>>")
    got = spark.range(1).select(F.inline(literal)).select(features(F.col("left"), F.col("value"), F.col("right")).alias("f"), "y").collect()
    return grow(np.array([[r["f"][k] for k in NAMES] for r in got]), np.array([r["y"] for r in got], float))


def scan(docs: DataFrame, forest: list | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``findings`` and ``redacted``, which take the place of columns of these names."""
    rest = [c for c in docs.columns if c not in ("findings", "redacted")]
    return scanned(docs, forest, threshold).select(*[F.col("doc").getField(c).alias(c) for c in rest], "findings", "redacted")


def scanned(docs: DataFrame, forest: list | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc, findings, redacted): every row of ``docs`` as a struct; an array of (start, end, score) of all candidates; the masked text."""
    forest = forest or train(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pattern = F.lit(SCANNED)
    found = F.regexp_extract_all(text, pattern, F.lit(0))

    def judge(v: Column, i: Column, gaps: Column, before: Column, after: Column) -> Column:
        # A candidate with the gap beside it has six characters or more on average, so eight of them reach over NEAR.
        left = F.concat(F.array_join(F.slice(before, F.greatest(i - 7, F.lit(1)), F.least(i, F.lit(8))), ""), F.get(gaps, i))
        right = F.concat(F.get(gaps, i + 1), F.array_join(F.slice(after, i + 2, 8), ""))
        return let(features(F.right(left, F.lit(NEAR)), v, F.left(right, F.lit(NEAR))), lambda f: F.struct(F.length(F.get(gaps, i)).cast("long").alias("gap"), F.length(v).cast("long").alias("n"), compile_forest(forest, f).alias("score")))

    def judged_all(m: Column, gaps: Column) -> Column:
        before = F.transform(m, lambda v, i: F.right(F.concat(F.get(gaps, i), v), F.lit(NEAR)))
        after = F.transform(m, lambda v, i: F.left(F.concat(v, F.get(gaps, i + 1)), F.lit(NEAR)))
        return let(F.struct(before.alias("before"), after.alias("after")), lambda c: F.transform(m, lambda v, i: judge(v, i, gaps, c["before"], c["after"])))

    def place(judged: Column) -> Column:
        none = F.array().cast("array<struct<start:bigint,end:bigint,score:double>>")

        def step(a: Column, j: Column) -> Column:
            start = a["at"] + j["gap"]
            return F.struct((start + j["n"]).alias("at"), F.array_append(a["out"], F.struct(start.alias("start"), (start + j["n"]).alias("end"), j["score"].alias("score"))).alias("out"))

        return F.aggregate(judged, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), step, lambda a: a["out"])

    def both(m: Column) -> Column:
        def of(gaps: Column) -> Column:
            def result(judged: Column) -> Column:
                clean = F.array_join(F.transform(judged, lambda j, i: F.concat(F.get(gaps, i), F.when(j["score"] >= threshold, F.lit(MASK)).otherwise(F.get(m, i)))), "")
                return F.struct(place(judged).alias("findings"), F.concat(clean, F.element_at(gaps, -1)).alias("redacted"))

            return let(judged_all(m, gaps), result)

        return let(F.split(text, SCANNED), of)

    empty = F.struct(F.array().cast("array<struct<start:bigint,end:bigint,score:double>>").alias("findings"), F.col("text").cast("string").alias("redacted"))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), let(found, lambda m: F.when(F.size(m) == 0, empty).otherwise(both(m))).alias("scan"))
    return out.select("doc", F.col("scan.findings").alias("findings"), F.col("scan.redacted").alias("redacted"))


def summary(scanned: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_candidates, n_secrets, spans, redacted_sha256): no secret is repeated in a report."""
    sure = F.filter("findings", lambda f: f["score"] >= threshold)
    spans = F.array_join(F.transform(sure, lambda f: F.concat_ws(":", f["start"], f["end"])), ",")
    return scanned.select("doc_id", F.size("findings").cast("long").alias("n_candidates"), F.size(sure).cast("long").alias("n_secrets"), spans.alias("spans"), F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))
