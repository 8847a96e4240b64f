"""Personal data by weak-supervision aggregation.

Four base kinds are found by fixed patterns and always stay.  Further candidates (phones
without a country code, written-out addresses, identity numbers, accounts, titled names) are
judged: pattern, validity, gazetteer, context and boundary labelers each vote for, against or not at all;
expectation-maximisation over all vote patterns of the corpus estimates how reliable
each labeler is; the resulting soft labels train a logistic span classifier, which
decides on every candidate by its votes, its shape (length, share of digits, separators,
capitals) and its place in the line, and by pairs of kind and vote.  Only candidates that it accepts compete for the
text: where they overlap the earlier stays, of equal starts the longer.

Texts are read once.  The vote patterns that reach the driver are bounded by
construction (10 kinds x 3 ** 5 votes x 6 lengths x 4 digit shares x 4 separators x 2 capitals x 3 places), whatever the input.

Defined results: a null text is empty; spans are code points, end exclusive; spans
of one kind never overlap, and an added span never overlaps another one; repeated rows are
searched one by one; texts, names and addresses are never cut, and every pattern takes linear time; columns beyond doc_id and
text do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

BASE = ("email", "ip", "card", "phone")
ADDED = ("local_phone", "spelled_email", "ssn", "iban", "mac", "name")
LABELERS = ("pattern", "validity", "gazetteer", "context", "boundary")

TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Señor", "Señora")
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah "
    "Hans Peter Anna Maria Klaus Ursula Jürgen Monika Stefan Petra Jean Marie Pierre Michel Nathalie Philippe Isabelle "
    "José Carmen Antonio Manuel Francisco Juan Dolores Pilar Ana Laura"
).split()
FOR_WORDS = ("phone", "tel", "call", "mobile", "fax", "contact", "mail", "reach", "ssn", "social security", "iban", "account", "mac", "name", "born", "telefon", "anruf", "teléfono", "téléphone", "konto")
AGAINST_WORDS = ("version", "order", "invoice", "page", "figure", "isbn", "serial", "part no", "item", "ref", "table", "score", "chapter", "line")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_finder():
    """A function from a text to its base spans (kind number, start, end).

    Each search gives what a leftmost scan with the kind's pattern gives, in linear time: runs that
    a scan would try again from every place are taken once.
    """
    import re

    domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
    card = re.compile(r"[0-9](?:[ -]?[0-9])+")
    phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
    digits = re.compile(r"[^0-9]+")

    def of(text: str) -> list[tuple[int, int, int]]:
        out = []
        end = 0
        at = text.find("@")
        while at >= 0:
            a = at
            while a > end and text[a - 1] in local:
                a -= 1
            m = domain.match(text, at + 1) if a < at else None
            if m:
                out.append((0, a, m.end()))
                end = m.end()
            else:
                end = max(end, at + 1)
            at = text.find("@", max(at + 1, end))
        for m in ip.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in card.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := digits.sub("", m[0])) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in phone.finditer(text):
                if 9 <= len(digits.sub("", m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
        return out

    return of


def candidate_finder():
    """A function from a text to candidates (added kind number, start, end)."""
    import re

    patterns = {
        0: re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9])"),
        2: re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
        3: re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
        4: re.compile(r"(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:-])"),
    }
    # Names, hosts and words of any length; possessive, so that a run is tried once.
    spelled = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++(?: ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?:(?: ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)+")
    dotted = re.compile(r"(?:[(\[]dot[)\]]| dot )")
    # A title, then one or two capitalised words.
    name = re.compile(r"\b(?:" + "|".join(TITLES) + r")\.? [^\W\d_a-z][^\W\d_A-Z]++(?: [^\W\d_a-z][^\W\d_A-Z]++)?")
    digit = re.compile(r"[0-9]")

    def of(text: str) -> list[tuple[int, int, int]]:
        out = []
        if digit.search(text):
            for k, p in patterns.items():
                out += [(k, m.start(), m.end()) for m in p.finditer(text)]
        if dotted.search(text):
            out += [(1, m.start(), m.end()) for m in spelled.finditer(text)]
        out += [(5, m.start(), m.end()) for m in name.finditer(text)]
        return out

    return of


def voter():
    """A function (text, kind name, start, end) -> a key: kind, five votes, classes of length, digits, separators, capitals and place."""
    import re

    near = re.compile("|".join(map(re.escape, FOR_WORDS)), re.IGNORECASE)
    far = re.compile("|".join(map(re.escape, AGAINST_WORDS)), re.IGNORECASE)
    names = frozenset(GIVEN_NAMES)

    def valid(kind: str, s: str) -> int:
        d = re.sub(r"[^0-9]", "", s)
        if kind == "ssn":
            return 1 if d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000" else -1
        if kind == "iban":
            x = s.replace(" ", "")
            return 1 if 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 else -1
        if kind in ("local_phone", "phone"):
            return 1 if len(d) in (9, 10, 11, 12) and len(set(d)) > 2 else -1
        if kind == "card":
            return 1 if luhn(d) else -1
        if kind == "mac":
            return -1 if len(set(s.lower()) - set(":-")) < 3 else 1
        return 0

    def of(text: str, kind: str, a: int, b: int) -> str:
        s = text[a:b]
        before, after = text[max(0, a - 40) : a], text[b : b + 12]
        digits = sum(c.isdigit() for c in s)
        pattern = -1 if kind == "spelled_email" and "(" not in s and "[" not in s else 1
        listed = 0
        if kind == "name":
            listed = 1 if any(w in names for w in s.split()) else 0
        elif kind in ("email", "spelled_email"):
            listed = 1 if re.search(r"(?i)(com|org|net|edu|de|fr|es|io)$", s) else 0
        elif kind == "local_phone":
            listed = 1 if s[0] in "(0" else 0  # an area code in brackets or behind a trunk prefix
        context = (1 if near.search(before) else 0) - (1 if far.search(before) else 0)
        glued = (a > 0 and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum())
        if digits:  # figures beside it, one separator off, belong to one longer number
            glued = glued or (a > 1 and text[a - 2].isdigit()) or (b + 1 < len(text) and text[b + 1].isdigit())
        votes = (pattern, valid(kind, s), listed, context, -1 if glued else 1 if not after or after[0] in " .,;:!?\n)\"'" else 0)
        length = min(5, len(s) // 8)
        share = 0 if not digits else 1 + min(2, 3 * digits // len(s))
        marks = 0 if s.isalnum() else 1 if " " not in s else 2 if s.replace(" ", "").isalnum() else 3
        capitals = int(any(c.isupper() for c in s))
        line = text.rfind("\n", 0, a) + 1
        place = 0 if not text[line:a].strip() else 2 if before.rstrip().endswith((":", "=", "(", "<")) else 1
        return f"{kind}|{','.join(map(str, votes))}|{length}|{share}|{marks}|{capitals}|{place}"

    return of


def reader():
    """An Arrow mapper (doc_id, text) -> (doc_id, base, cands); spans with their vote keys."""

    def run(batches: Iterator):
        import pyarrow as pa

        base, more, key = base_finder(), candidate_finder(), voter()
        span = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("key", pa.string())]))
        for batch in batches:
            firsts, cands = [], []
            for t in batch.column("text").to_pylist():
                t = t or ""
                found = sorted(base(t))
                firsts.append([{"kind": BASE[k], "a": a, "b": b, "key": key(t, BASE[k], a, b)} for k, a, b in found])
                cands.append([{"kind": ADDED[k], "a": a, "b": b, "key": key(t, ADDED[k], a, b)} for k, a, b in more(t)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(firsts, span), pa.array(cands, span)], ["doc_id", "base", "cands"])

    return run


def split_key(key: str) -> tuple[str, tuple[int, ...], tuple[str, ...]]:
    """Kind, votes, and the classes of shape and place."""
    kind, votes, *shape = key.split("|")
    return kind, tuple(map(int, votes.split(","))), tuple(shape)


def reliabilities(counts: dict[str, int], rounds: int = 50) -> tuple[list[dict[int, tuple[float, float]]], dict[str, float]]:
    """EM over vote patterns: P(vote | not personal, personal) of each labeler, and each key's posterior."""
    import math

    keys = {k: split_key(k)[1] for k in sorted(counts)}
    post = {k: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for k, v in keys.items()}
    tables: list[dict[int, tuple[float, float]]] = []
    for _ in range(rounds):
        yes = sum(counts[k] * post[k] for k in keys) + 1
        no = sum(counts[k] * (1 - post[k]) for k in keys) + 1
        tables = []
        for j in range(len(LABELERS)):
            t = {}
            for v in (-1, 0, 1):
                # A labeler is taken to err less often than not: that keeps the two classes apart.
                good, bad = (1.0, 3.0) if v < 0 else (3.0, 1.0) if v > 0 else (2.0, 2.0)
                p = (sum(counts[k] * post[k] for k, x in keys.items() if x[j] == v) + good) / (yes + 6)
                q = (sum(counts[k] * (1 - post[k]) for k, x in keys.items() if x[j] == v) + bad) / (no + 6)
                t[v] = (q, p)
            tables.append(t)
        odds = math.log(yes / no)
        new = {}
        for k, x in keys.items():
            s = odds + sum(math.log(tables[j][v][1] / tables[j][v][0]) for j, v in enumerate(x))
            new[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))
        change = max((abs(new[k] - post[k]) for k in keys), default=0)
        post = new
        if change < 1e-9:
            break
    return tables, post


SHAPE = ("length", "share", "marks", "capitals", "place")


def features(key: str) -> list[str]:
    kind, votes, shape = split_key(key)
    said = [f"{n}={v}" for n, v in zip(LABELERS, votes, strict=True)]
    return ["bias", f"kind={kind}", *[f"{n}={v}" for n, v in zip(SHAPE, shape)], *said, *[f"{kind}&{x}" for x in said]]


def free_of(base: list[dict], accepted: list[dict]) -> list[dict]:
    """The accepted spans that overlap neither a base span nor one that comes before."""
    from bisect import bisect_right

    taken: list[list[int]] = []  # the base spans, merged
    for a, b in sorted((x["a"], x["b"]) for x in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    out, free = [], 0
    for x in sorted(accepted, key=lambda x: (x["a"], -x["b"], x["kind"])):
        before = bisect_right(taken, x["b"] - 1, key=lambda t: t[0])
        if x["a"] >= free and (not before or taken[before - 1][1] <= x["a"]):
            out.append(x)
            free = x["b"]
    return out


def train(counts: dict[str, int], rounds: int = 400, rate: float = 0.5, decay: float = 0.01) -> dict[str, float]:
    """Weights of the span classifier, from soft labels weighted by the log of their counts."""
    import math

    _, post = reliabilities(counts)
    rows = [(features(k), post[k], 1 + math.log(n)) for k, n in sorted(counts.items())]
    total = sum(r[2] for r in rows) or 1
    w: dict[str, float] = {f: 0.0 for r in rows for f in r[0]}
    for _ in range(rounds):
        g = {f: decay * v for f, v in w.items()}
        for fs, y, n in rows:
            e = n / total * (1 / (1 + math.exp(-sum(w[f] for f in fs))) - y)
            for f in fs:
                g[f] += e
        for f in w:
            w[f] -= rate * g[f]
    return w


def decider(weights: dict[str, float], threshold: float):
    """An Arrow mapper that writes counts, the base digest and all spans."""

    def run(batches: Iterator):
        import hashlib
        import math

        import pyarrow as pa

        order = {k: i for i, k in enumerate((*BASE, *ADDED))}
        known: dict[str, bool] = {}

        def personal(key: str) -> bool:
            if key not in known:
                known[key] = 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in features(key)))) >= threshold
            return known[key]

        said = lambda spans: ",".join(f"{k}:{a}:{b}" for _, a, b, k in sorted((order[x["kind"]], x["a"], x["b"], x["kind"]) for x in spans))
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for base, cands in zip(b.column("base").to_pylist(), b.column("cands").to_pylist(), strict=True):
                for i, k in enumerate(BASE):
                    out[i].append(sum(x["kind"] == k for x in base))
                added = free_of(base, [x for x in cands if personal(x["key"])])
                out[4].append(hashlib.sha256(said(base).encode()).hexdigest())
                out[5].append(said(base + added))
                out[6].append(len(added))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(v, t) for v, t in zip(out, kinds, strict=True)]], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return run


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): no shuffle but of vote counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,a:bigint,b:bigint,key:string>>"
    found = written(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(reader(), f"doc_id {kind}, base {span}, cands {span}"))
    keys = found.select(F.explode(F.concat("base.key", "cands.key")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    weights = train({r["key"]: r["n"] for r in keys.collect()})
    return found.mapInArrow(decider(weights, threshold), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
