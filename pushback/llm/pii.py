"""Personal data: pattern spans, and information-theoretic sanitisation of the terms around them.

The base spans are e-mail addresses, IPv4-like numbers, card numbers (Luhn) and
phone numbers.  They are the protected entities.  The words within ``reach``
words of an entity are its context.  Over all documents it is counted how often
a term occurs at all, how often in contexts of each entity and how often in
contexts of each kind.  With p(x) the share of all words that stand in contexts
of x (an entity or a kind), and p(x|t) the share of a term's occurrences that do,

    PMI(t; x) = log2(p(x|t) / p(x)),    IC(x) = -log2 p(x),

and a term discloses x if PMI / IC reaches ``disclosure`` (1 means that the
term never occurs without x).  Contexts of the same words count as one where
evidence is weighed, so that copies of one document prove nothing: an entity is
disclosed by a term of at least ``evidence`` different contexts, a kind by one
of at least ``support``.
Disclosing terms become spans of kind ``term`` where they stand in a context of
the entity or kind that they disclose; elsewhere nothing is marked.  ``sanitise`` replaces base spans by the
name of their kind and generalises disclosing terms.

Edge cases: null texts are empty; repeated rows each keep their own result;
spans are counted in code points; a table without entities has no term spans;
empty tables give empty results; ``sanitise`` keeps all columns (its helper
columns start with ``__pii_``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_filter, may_hold, row_key, slices, table, words_of, written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
REACH, DISCLOSURE, SUPPORT, EVIDENCE = 8, 0.9, 20, 2

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(rb"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Terms are words without what stands around them; the same in counts and contexts.
_EDGES = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
_STRIP = _EDGES.encode()

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """From sign to sign: the local part is the run of its characters before ``@`` that no match has used."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield "email", start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[Span]:
    """Four parts at a time of each run of dotted numbers."""
    for m in _NUMBERS.finditer(text):
        parts = m[0].split(".")
        start = m.start()
        while len(parts) >= 4:
            four, parts = parts[:4], parts[4:]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield "ip", start, end
            start = end + 1


def _luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield "card", *m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield "phone", *m.span()


def base_spans(raw: bytes | None) -> tuple[str, list[Span]]:
    """The text and its base spans, by kind and start; texts without ``@`` and digits are not decoded."""
    if not raw or (b"@" not in raw and not _DIGIT.search(raw)):
        return "", []
    text = raw.decode("utf-8", "replace")
    return text, [*emails(text), *ips(text), *cards(text), *phones(text)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def contexts(text: str, spans: list[Span], reach: int) -> Iterator[tuple[str, int, int, bool, str, int, int]]:
    """(kind, hash of the entity, hash of the context, first, term, start, end) of each term within ``reach`` words of an entity.

    Not first: the same entity stands near the same word once more.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    taken = sorted((a, b) for _, a, b in spans)
    terms, k = [], 0
    for a, b in words:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        own = text[a:b].lstrip(_EDGES)
        lead = b - a - len(own)
        term = own.rstrip(_EDGES)
        free = not (k < len(taken) and taken[k][0] < b)
        terms.append((term.lower() if term.isascii() else term, a + lead, a + lead + len(term)) if free and term and not term.isdigit() else None)
    starts = [a for a, _ in words]
    from bisect import bisect_left

    seen: set[tuple[str, int, int]] = set()
    for kind, a, b in spans:
        first, last = bisect_left(starts, a), bisect_left(starts, b)
        low, high = max(0, first - reach), min(len(terms), last + reach)
        entity = xxhash.xxh3_64_intdigest(text[a:b].encode()) - (1 << 63)
        context = xxhash.xxh3_64_intdigest(" ".join(text[x:y] for x, y in words[low:high]).encode()) - (1 << 63)
        for i in (*range(low, first), *range(last, high)):
            if terms[i]:
                yield kind, entity, context, (kind, entity, i) not in seen, *terms[i]
                seen.add((kind, entity, i))


_FIELDS = ("kind", "entity", "context", "first", "term", "start", "end")
_CONTEXT = pa.list_(pa.struct(list(zip(_FIELDS, (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64())))))
_ROWS = ("doc_id long, doc_row long, n_words long, n_email long, n_ip long, n_card long, n_phone long, base string, "
         "contexts array<struct<kind string, entity long, context long, first boolean, term string, start long, end long>>")


def _scan(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        counts, base, around, n_words = [], [], [], []
        for raw in batch.column("text").to_pylist():
            text, spans = base_spans(raw)
            found = Counter(k for k, _, _ in spans)
            counts.append([found[k] for k in KINDS])
            base.append(joined(spans))
            around.append([dict(zip(_FIELDS, c)) for c in contexts(text, spans, reach)] if spans else [])
            n_words.append(len(words_of(raw)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc_row"), pa.array(n_words, pa.int64()),
             *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)), pa.array(base), pa.array(around, _CONTEXT)],
            names=["doc_id", "doc_row", "n_words", *(f"n_{k}" for k in KINDS), "base", "contexts"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each term occurs in a slice of texts."""
    for batch in slices(batches, "text", 16 << 20):
        raw: Counter[bytes] = Counter()
        for text in batch.column("text").to_pylist():
            raw.update(words_of(text))
        terms: Counter[str] = Counter()
        for w, n in raw.items():
            w = w.strip(_STRIP)
            if w and not w.isdigit():
                terms[(w.lower() if w.isascii() else w).decode("utf-8", "replace")] += n
        yield pa.RecordBatch.from_arrays([pa.array(terms.keys(), pa.string()), pa.array(terms.values(), pa.int64())],
                                         names=["term", "n"])


def find(docs: DataFrame, reach: int = REACH, disclosure: float = DISCLOSURE, support: int = SUPPORT,
         evidence: int = EVIDENCE) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, doc_row, n_email, n_ip, n_card, n_phone, base, terms (sorted array of start, end)."""
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("doc_row"),
                         F.col("text").cast("binary").alias("text"))
    rows = written(inputs.mapInArrow(lambda it: _scan(it, reach), _ROWS), "pii")
    near = rows.where(F.size("contexts") > 0).select("doc_id", "doc_row", F.explode("contexts").alias("c")).select("doc_id", "doc_row", "c.*")
    pairs = (near.groupBy("kind", "entity", "term", "context").agg(F.count("*").alias("joint"), F.count_if("first").alias("once"))
             .groupBy("kind", "entity", "term").agg(F.sum("joint").alias("joint"), F.sum("once").alias("once"), F.count("*").alias("contexts")))
    pairs = written(pairs, "pii-pairs")
    by_kind = (pairs.groupBy("kind", "term").agg(F.sum("joint").alias("joint"), F.sum("contexts").alias("contexts"))
               .where(F.col("contexts") >= support).drop("contexts"))
    by_entity = pairs.where(F.col("contexts") >= evidence).select("kind", "entity", "term", F.col("once").alias("joint"))
    terms = written(by_kind.select("term").unionByName(by_entity.select("term")).distinct(), "pii-candidates")
    counts = inputs.select("text").mapInArrow(_count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).join(terms, "term")
    counts = written(counts, "pii-counts")
    total = rows.agg(F.sum("n_words").alias("total"))  # one row
    share = F.col("near") / F.col("total")
    discloses = F.log2(F.col("joint") / F.col("n") / share) >= -disclosure * F.log2(share)

    def disclosing(joint: DataFrame, near: DataFrame, key: list[str]) -> DataFrame:
        judged = joint.join(counts, "term").join(near, key).crossJoin(F.broadcast(total))
        return written(judged.where(discloses).select(*key, "term"), "pii-terms")

    kinds = pairs.groupBy("kind").agg(F.sum("joint").alias("near"))  # four rows at most
    entities = pairs.groupBy("kind", "entity").agg(F.sum("once").alias("near"))
    of_kind = disclosing(by_kind, F.broadcast(kinds), ["kind"])
    of_entity = disclosing(by_entity, entities, ["kind", "entity"])
    marked = near.join(of_kind, ["kind", "term"], "left_semi").unionByName(near.join(of_entity, ["kind", "entity", "term"], "left_semi"))
    spans = marked.groupBy("doc_id", "doc_row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("terms"))
    own = rows.drop("contexts", "n_words")
    same = own["doc_id"].eqNullSafe(spans["doc_id"]) & (own["doc_row"] == spans["doc_row"])
    return own.join(spans, same, "left").select(*(own[c] for c in own.columns), "terms")


def _replace(batches: Iterator[pa.RecordBatch], text_column: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text_column):
        texts = []
        own = batch.column(text_column).cast(pa.binary())
        for raw, base, terms in zip(own, *(batch.column(c).to_pylist() for c in ("__pii_base", "__pii_terms"))):
            if not base and not terms:
                texts.append(raw.as_py())
                continue
            text = raw.as_py().decode("utf-8", "replace")
            spans = [(int(a), int(b), k.upper()) for k, a, b in (s.split(":") for s in (base or "").split(",") if s)]
            spans += [(t["start"], t["end"], TERM.upper()) for t in terms or []]
            out, end = [], 0
            for a, b, name in sorted(spans, key=lambda s: (s[0], -s[1])):
                if a >= end:  # within another span there is nothing left to hide, a longer one goes on below
                    out += [text[end:a], f"<{name}>"]
                end = max(end, b)
            texts.append("".join([*out, text[end:]]).encode())
        arrays = [pa.array(texts, pa.binary()).cast(pa.string()) if c == text_column else batch.column(c)
                  for c in batch.schema.names if not c.startswith("__pii_")]
        yield pa.RecordBatch.from_arrays(arrays, names=[c for c in batch.schema.names if not c.startswith("__pii_")])


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with base spans replaced by ``<EMAIL>`` and so on and disclosing terms by ``<TERM>``."""
    found = find(docs.select("doc_id", "text"), **options).where("base <> '' OR terms IS NOT NULL")
    found = written(found.select(F.col("doc_id").alias("__pii_id"), F.col("doc_row").alias("__pii_row"),
                                 F.col("base").alias("__pii_base"), F.col("terms").alias("__pii_terms")).distinct(), "pii-found")
    keyed = may_hold(docs.withColumn("__pii_key", row_key("doc_id", "text")), "__pii_key", key_filter(found, "__pii_row"))
    clean = keyed.where("NOT __may").select(*docs.columns)  # most texts have nothing to replace, and need no join
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__pii_id")) & (F.col("__pii_key") == F.col("__pii_row"))
    asked = keyed.where("__may").drop("__may").join(found.hint("merge"), same, "left")
    replaced = asked.drop("__pii_id", "__pii_row", "__pii_key").mapInArrow(lambda it: _replace(it, "text"), docs.schema)
    return replaced.unionByName(clean)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    terms = F.transform(F.coalesce("terms", F.array().cast("array<struct<start:long,end:long>>")),
                        lambda t: F.concat_ws(":", F.lit(TERM), t["start"], t["end"]))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), terms)
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))
