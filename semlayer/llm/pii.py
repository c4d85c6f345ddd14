"""Personal data by bootstrapped contextual extraction.

Four base rules find e-mail addresses, IPv4 addresses, payment cards and phone numbers.  Their
matches are the seeds of a bootstrap over the whole corpus.  An instance is any run of digit groups
joined by blanks, dots, hyphens and brackets, and any other token with a digit or an @ in it, outside all
base matches; its patterns are the one or two words before it together with its coarse form.  Spark
holds the graph of patterns and instances and scores it in rounds:

    score of a pattern for a kind = share of its distinct instances that are trusted as that kind
    score of an instance          = 1 - product of (1 - score) over its good patterns

A pattern is good with at least LEAST_SUPPORT trusted instances and a score of LEAST_SCORE; an
instance is trusted from LEAST_TRUST and keeps its kind.  Rounds go on until none adds an instance;
then the trusted instances that no base rule had found add their spans; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import written
from .exchange import given_back, text_slices

KINDS = ("email", "ip", "card", "phone")
LEAST_SUPPORT = 5
LEAST_SCORE = 0.7
LEAST_TRUST = 0.9

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Digit groups and what joins them; a dot before white space ends a sentence.  No group touches a letter.
RUN = re.compile(
    r"(?<!\w)[+(\[]*+[0-9]++(?!\w)(?:(?:[\x20\t\xa0()\[\]-]|\.(?!\s))++[0-9]++(?!\w))*+"
)
#: What ends at characters that no identifier has inside.
TOKEN = re.compile(r"[^ \t\n\r\v\f\"'(),;<>\[\]{}=|]+")
TELLING = re.compile(r"[0-9@]")
WORD = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    """The check sum of payment cards."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all base matches in order."""
    spans = []
    if "@" in text:
        spans += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def shape(token: str) -> str:
    """A token's coarse form: with an @, with letters and digits, or with digits and marks only."""
    return "@" if "@" in token else "a9" if any(c.isalpha() for c in token) else "9"


def before(text: str, start: int, words: list[tuple[int, int]]) -> list[str]:
    """The one and the two words before a position; the start of a text counts as a word."""
    upto = bisect_left(words, (start, 0))
    left = [text[s : min(e, start)].lower() for s, e in words[max(0, upto - 2) : upto]]
    left = ["^", "^", *left][-2:]
    return [left[1], f"{left[0]} {left[1]}"]


def runs(text: str, low: int, high: int) -> list[tuple[int, int]]:
    """Spans of runs of digit groups; a bracket that the run does not close stays outside."""
    out = []
    for m in RUN.finditer(text, low, high):
        s, e = m.span()
        while text[s] in "([" and ")]"["([".index(text[s])] not in m.group():
            s += 1
        out.append((s, e))
    return out


def tokens(text: str, low: int, high: int) -> list[tuple[int, int]]:
    """Spans of tokens with a digit or an @, without marks that end a sentence."""
    out = []
    for m in TOKEN.finditer(text, low, high):
        if TELLING.search(m.group()):
            out.append((m.start(), m.start() + len(m.group().rstrip(".:!?-"))))
    return out


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds, and runs and tokens outside all base spans, with their patterns."""
    out = [{"start": s, "end": e, "form": text[s:e], "kind": KINDS[k]} for s, k, e in spans]
    if not spans and not TELLING.search(text):
        return out
    at = 0
    for low, high in [*((s, e) for s, _, e in spans), (len(text), len(text))]:
        if low > at:
            found = runs(text, at, low)
            starts = [s for s, _ in found]
            for s, e in tokens(text, at, low):
                k = bisect_left(starts, s + 1) - 1
                if k < 0 or e > found[k][1]:
                    found.append((s, e))
            out += [{"start": s, "end": e, "form": text[s:e], "kind": None} for s, e in found]
        at = max(at, high)
    words = [m.span() for m in WORD.finditer(text)]
    for one in out:
        one["patterns"] = [f"{left}\t{shape(one['form'])}" for left in before(text, one["start"], words)]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


FOUND = (
    "doc_id bigint, row bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
    "base_sha256 string, instances array<struct<start:bigint,end:bigint,form:string,kind:string,patterns:array<string>>>"
)


def base_found(documents: DataFrame) -> DataFrame:
    """Of each row: base matches and instances; `row` is a code of the text."""
    kind = pa.list_(
        pa.struct(
            [
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("form", pa.string()),
                ("kind", pa.string()),
                ("patterns", pa.list_(pa.string())),
            ]
        )
    )

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            columns: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base": [], "base_sha256": [], "instances": []}
            for text in batch["text"].to_pylist():
                text = text or ""
                spans = base_spans(text)
                for i, k in enumerate(KINDS):
                    columns[f"n_{k}"].append(sum(s[1] == i for s in spans))
                columns["base"].append(joined(spans))
                columns["base_sha256"].append(hashlib.sha256(columns["base"][-1].encode()).hexdigest())
                columns["instances"].append(instances(text, spans))
            arrays = {"doc_id": batch["doc_id"], "row": batch["row"]}
            arrays |= {f"n_{k}": pa.array(columns[f"n_{k}"], pa.int64()) for k in KINDS}
            arrays |= {c: pa.array(columns[c], pa.string()) for c in ("base", "base_sha256")}
            yield pa.record_batch(arrays | {"instances": pa.array(columns["instances"], kind)})

    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return docs.mapInArrow(given_back(run), FOUND)


def bootstrapped(graph: DataFrame, rounds: int | None = None) -> DataFrame:
    """(form, kind) of instances that the patterns discover, in so many rounds or as long as any is added.

    `graph` has a row for each distinct form, pattern and seed kind (null for instances that
    are no seeds).
    """
    seeds = graph.where("kind is not null").select("form", "kind").distinct()
    edges = written(graph.select("form", "pattern").distinct(), "pii-edges")
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    trusted = written(seeds, "pii-seeds")
    found, seeds = trusted.limit(0), trusted
    while rounds is None or rounds > 0:
        good = (
            edges.join(trusted, "form")
            .groupBy("pattern", "kind")
            .agg(F.count("*").alias("hits"))
            .where(F.col("hits") >= LEAST_SUPPORT)
            .join(size, "pattern")
            .withColumn("score", F.col("hits") / F.col("n"))
            .where(F.col("score") >= LEAST_SCORE)
        )
        more = (
            edges.join(trusted.select("form"), "form", "left_anti")
            .join(good, "pattern")
            .groupBy("form", "kind")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("score"))
            .where(F.col("score") >= LEAST_TRUST)
            .groupBy("form")
            .agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        )
        more = written(more, "pii-more")
        if more.isEmpty():
            break
        found = written(found.union(more), "pii-found")
        trusted = seeds.union(found)
        rounds = None if rounds is None else rounds - 1
    return found


def row_spans(documents: DataFrame, rounds: int | None = None) -> DataFrame:
    """The columns of `personal_data` and `row`, the xxhash64 of the text they were found in."""
    base = written(base_found(documents), "pii-base")
    each = base.select("doc_id", "row", F.explode("instances").alias("i"))
    graph = each.select("i.form", "i.kind", F.explode("i.patterns").alias("pattern")).distinct()
    found = bootstrapped(graph, rounds)
    more = (
        each.where("i.kind is null")
        .select("doc_id", "row", "i.start", "i.end", "i.form")
        .distinct()
        .join(found, "form")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("start", "end", "kind")).alias("more"))
        .select(F.col("doc_id").alias("id"), F.col("row").alias("code"), "more")
    )
    both = base.drop("instances").join(more, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("row").eqNullSafe(F.col("code")), "left")

    def run(batches):
        for batch in batches:
            spans = []
            for own, extra in zip(batch["base"].to_pylist(), batch["more"].to_pylist()):
                parts = [x.split(":") for x in own.split(",") if x]
                rows = [(int(s), KINDS.index(k), int(e)) for k, s, e in parts]
                rows += [(x["start"], KINDS.index(x["kind"]), x["end"]) for x in extra or []]
                spans.append(joined(rows))
            kept = [c for c in batch.schema.names if c not in ("base", "more")]
            yield pa.record_batch({c: batch[c] for c in kept} | {"spans": pa.array(spans, pa.string())})

    columns = ["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "more"]
    schema = "doc_id bigint, row bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return both.select(*columns).mapInArrow(run, schema)


def personal_data(documents: DataFrame, rounds: int | None = None) -> DataFrame:
    """One row for each row of `documents` (doc_id, text): counts of base matches and all spans.

    doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of base matches as kind:start:end, by start, then
    kind as listed, joined by commas), spans (base and discovered ones alike).  Offsets are code
    points, ends exclusive.  A null text is empty and has none.
    """
    return row_spans(documents, rounds).drop("row")


def masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlaps merge."""
    out, at = [], 0
    rows = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x)]
    for start, end, kind in rows:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
