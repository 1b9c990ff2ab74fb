"""Information-theoretic sanitisation of personal data.

Rules find e-mail addresses, IPs, card and phone numbers: the protected entities.  The corpus then tells how strongly
a term reveals an entity.  Everything is counted in documents (rows): information content IC(e) = -log2 P(e), pointwise
mutual information PMI(e, t) = log2(P(e, t) / P(e) P(t)), where e and t may stand anywhere in a document.  A term
discloses an entity when PMI >= ``ALPHA`` * IC, that is, when knowing the term gives away that share of the entity's
information, and when their meeting is no accident: they meet in two different texts at least, and the chance of so
many meetings of independent words (a Poisson tail's Chernoff bound) times the entity's terms is at most ``CHANCE``.
All occurrences of a disclosing term, in any document, are generalised, or removed when PMI reaches IC itself (the
term stands nowhere else).  An entity of a single text meets all the words of that text once, which says nothing
about any of them.

Pairs stay few without a cap: entities that stand in exactly the same texts are one class, and so are terms; a term
is paired with a class only if its frequency in texts with recurring entities, a lower bound of that in the corpus,
lets it reach the threshold at all, which leaves the frequent terms out.  Document frequencies of the terms that meet
an entity twice come from one scan: tasks count the distinct words of their documents that a bitmap of hashes lets
through (``BITS`` bits whatever the corpus; false hits drop out in the join).

The disclosing terms go to the executors in blocks of at most ``BLOCK_TERMS``; more terms mean more scans, not a
larger broadcast.

Nulls: a null text is empty.  Repeated rows count as documents in the frequencies, but copies of one text never make
a term disclosing by themselves.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tablewright.llm.common import WordHash, cut, documents, fold, scan, utf8
from tablewright.llm.spans import Span, digest, joined, replace, to_code_points

KINDS = ("email", "ip", "card", "phone", "term")
ALPHA = 0.8
CHANCE = 0.05
BITS = 27
BLOCK_TERMS = 500_000

# The rules, anchored where a run of digits or a plus sign begins.
IP = re.compile(rb"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(rb"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOLDED = re.compile(rb"[^ ]+")


def emails(body: bytes) -> Iterator[tuple[int, int]]:
    """From each @: the longest local part before it, back to the last match, and the domain after it."""
    end, at = 0, body.find(b"@")
    while at >= 0:
        size = 256
        while True:
            low = max(end, at - size)
            start = low + len(body[low:at].rstrip(LOCAL))
            if start > low or low == end:
                break
            size *= 4
        domain = DOMAIN.match(body, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = body.find(b"@", max(at + 1, end))


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def rule_spans(body: bytes) -> list[Span]:
    """The rules' findings, offsets in bytes."""
    found: list[Span] = []
    if b"@" in body:
        found += [("email", a, z) for a, z in emails(body)]
    if len(body.translate(None, b"0123456789")) == len(body):
        return found
    for m in IP.finditer(body):
        if all(len(x.lstrip(b"0")) <= 3 and int(x) <= 255 for x in m[0].split(b".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(body):
        digits = m[0].translate(None, b" -")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if b"+" in body:
        for m in PHONE.finditer(body):
            if 9 <= len(m[0].translate(None, b" ().-+")) <= 15:
                found.append(("phone", *m.span()))
    return found


def entities_and_terms(body: bytes, spans: list[Span]) -> tuple[list[bytes], list[bytes]]:
    """The distinct entities of a text and its distinct words outside them."""
    entities, rest, at = {}, [], 0
    for kind, a, z in sorted(spans, key=lambda s: s[1:]):
        held = body[a:z].translate(None, b" ().-") if kind in ("card", "phone") else body[a:z]
        entities[kind.encode() + b":" + held.lower()] = None
        if a > at:
            rest.append(body[at:a])
        at = max(at, z)
    rest.append(body[at:])
    return list(entities), list(dict.fromkeys(fold(b" ".join(rest)).split()))


def _texts_with_entities(bodies: DataFrame) -> DataFrame:
    """(label, n, entities, terms) of every text with an entity: n equal rows."""

    def make() -> Callable:
        def work(columns: list) -> list[tuple]:
            import xxhash

            held: dict[bytes, int] = {}
            for body in columns[0]:
                if body in held or rule_spans(body):
                    held[body] = held.get(body, 0) + 1
            return [
                (xxhash.xxh3_64_intdigest(body) - (1 << 63), n, *entities_and_terms(body, rule_spans(body)))
                for body, n in held.items()
            ]

        return work

    schema = StructType([
        StructField("label", LongType()), StructField("n", LongType()), StructField("entities", ArrayType(BinaryType())),
        StructField("terms", ArrayType(BinaryType())),
    ])
    return scan(bodies, make, schema)


def _classes(members: DataFrame, name: str) -> DataFrame:
    """(name, texts, rows, class) of members (label, n, name): those that stand in the same texts are one class.

    A class is known by its number of texts and two independent hashes over their labels.
    """
    mark = [F.bit_xor(F.xxhash64("label")), F.sum(F.pmod(F.xxhash64(F.lit(name), "label"), F.lit(1 << 40)))]
    each = members.groupBy(name).agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("rows"), *[
        m.alias(f"mark{i}") for i, m in enumerate(mark)])
    return each.where("texts >= 2").withColumn("class", F.xxhash64("texts", "mark0", "mark1"))


def disclosures(df: DataFrame, text: str = "text", alpha: float = ALPHA, chance: float = CHANCE) -> DataFrame:
    """Terms that disclose an entity: term, ic and pmi (bits) of the entity that it reveals most."""
    bodies = df.select(utf8(text).alias("body"))
    held = cut(_texts_with_entities(bodies))
    n_docs = df.count()
    labels = held.groupBy("label").agg(F.sum("n").alias("n"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    labels = cut(labels)
    # entities of two texts at least, as classes; one member stands for all
    entities = labels.select("label", "n", F.explode("entities").alias("entity"))
    classes = cut(_classes(entities, "entity").select("entity", F.col("class").alias("e_class"), F.col("rows").alias("n_entity")))
    in_texts = entities.join(classes, "entity").select("label", "e_class", "n_entity").distinct()
    in_texts = cut(in_texts.where(F.col("n_entity") < n_docs))
    # terms of their texts, two texts at least, as classes too
    texts = in_texts.select("label").distinct()
    terms = labels.join(texts, "label").select("label", "n", F.explode("terms").alias("term"))
    t_classes = _classes(terms, "term").select("term", F.col("class").alias("t_class"), F.col("rows").alias("n_held"))
    t_classes = cut(t_classes)
    members = terms.join(t_classes, "term").groupBy("label", "n", "t_class", "n_held").agg(F.count(F.lit(1)).alias("size"))
    # pmi >= alpha * ic means n_joint >= n_term * (n_entity / n_docs) ** (1 - alpha), where n_term >= n_held
    wide = F.pow(n_docs / F.col("n_entity"), F.lit(1 - alpha)) * 1.000001
    met = members.join(in_texts, "label").where(F.col("n_held") <= F.col("n_entity") * wide)
    met = met.groupBy("e_class", "t_class", "n_entity", "n_held").agg(
        F.sum("n").alias("n_joint"), F.count(F.lit(1)).alias("k"), F.max("size").alias("size"))
    met = cut(met)
    tests = met.groupBy("e_class").agg(F.sum("size").alias("tests"))
    pairs = cut(met.where((F.col("k") >= 2) & (F.col("n_held") <= F.col("n_joint") * wide)))
    # only terms that meet one entity in two texts are counted in the whole corpus
    wanted = cut(t_classes.join(pairs.select("t_class").distinct(), "t_class").select("term", "t_class"))
    frequency = cut(document_frequency(bodies, wanted.select("term")).join(wanted, "term"))
    scored = pairs.join(frequency.select("t_class", "n_term").distinct(), "t_class").join(tests, "e_class")
    expected = F.col("n_entity") * F.col("n_term") / n_docs
    odds = F.col("k") * F.log(F.col("k") / expected) - F.col("k") + expected
    scored = scored.where((F.col("k") > expected) & (odds >= F.log(F.col("tests") / chance)))
    ic = -F.log2(F.col("n_entity") / n_docs)
    pmi = F.log2(F.col("n_joint") * n_docs / (F.col("n_entity") * F.col("n_term")))
    scored = scored.withColumn("ic", ic).withColumn("pmi", F.least(pmi, F.col("ic"))).where(F.col("pmi") >= alpha * F.col("ic"))
    best = F.max_by(F.struct("ic", "pmi"), F.struct(F.col("pmi") / F.col("ic"), F.col("ic"))).alias("best")
    found = scored.groupBy("t_class", "n_term").agg(best).join(frequency, ["t_class", "n_term"])
    return cut(found.select("term", "best.ic", "best.pmi"))


def _blocks(terms: DataFrame, block_terms: int) -> list[DataFrame]:
    n = terms.count()
    if n <= block_terms:
        return [terms]
    k = -(-int(n * 1.2) // block_terms)
    return [terms.where(F.pmod(F.xxhash64("term"), F.lit(k)) == i) for i in range(k)]


def document_frequency(bodies: DataFrame, terms: DataFrame, bits: int = BITS) -> DataFrame:
    """(term, n_term): how many rows hold each of the terms."""

    def make_places() -> Callable:
        known = WordHash()

        def work(columns: list) -> list[tuple]:
            at = known.array([bytes(t) for t in columns[0]]) >> np.uint64(64 - bits)
            return list(zip((at >> np.uint64(3)).astype(np.int64).tolist(), (1 << (at & np.uint64(7)).astype(np.int64)).tolist()))

        return work

    place = StructType([StructField("byte", LongType()), StructField("bits", LongType())])
    # at most 2 ** (bits - 3) rows
    filled = scan(terms.select("term"), make_places, place, rows=50_000).groupBy("byte").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 3), np.uint8)
    table[filled["byte"].to_numpy()] = filled["bits"].to_numpy()
    sent = bodies.sparkSession.sparkContext.broadcast(table)

    def make() -> Callable:
        known, held = WordHash(), sent.value

        def work(columns: list) -> list[tuple]:
            out: Counter = Counter()
            for body in columns[0]:
                words = list(set(fold(body).split()))
                at = known.array(words) >> np.uint64(64 - bits)
                hit = held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                out.update(words[i] for i in np.flatnonzero(hit))
            return list(out.items())

        return work

    schema = StructType([StructField("term", BinaryType()), StructField("n", LongType())])
    counted = scan(bodies, make, schema).groupBy("term").agg(F.sum("n").alias("n_term"))
    return counted.join(terms, "term", "left_semi")


def term_spans(body: bytes, terms: dict[bytes, float]) -> list[tuple[int, int, bytes]]:
    """(start, end, term) of every occurrence of the terms, offsets in bytes."""
    folded = fold(body)
    held = terms.keys() & set(folded.split())
    if not held:
        return []
    return [(*m.span(), m[0]) for m in FOLDED.finditer(folded) if m[0] in held]


def find(
    df: DataFrame, terms: DataFrame, doc: str = "doc_id", text: str = "text", block_terms: int = BLOCK_TERMS,
    with_text: bool = False,
) -> DataFrame:
    """Per row: counts of the rules' findings, their digest, all spans, and with ``with_text`` the sanitised text.

    In the sanitised text an entity becomes its kind in brackets; a disclosing term becomes ``[TERM]``, or goes
    when it fully determines the entity.
    """
    sc = df.sparkSession.sparkContext
    state = df.select(F.col(doc), utf8(text).alias("_body"), F.lit(None).cast("array<bigint>").alias("_found"))
    blocks = _blocks(terms, block_terms)
    for i, block in enumerate(blocks):
        sent = sc.broadcast({bytes(r[0]): float(r[1]) for r in block.select("term", F.col("pmi") / F.col("ic")).collect()})
        last = i == len(blocks) - 1
        fields = [df.schema[doc]]
        if last:
            fields += [StructField(f"n_{k}", LongType()) for k in KINDS[:4]]
            fields += [StructField("base_sha256", StringType()), StructField("spans", StringType())]
            fields += [StructField("sanitised", StringType())] * with_text
        else:
            fields += [StructField("_body", BinaryType()), StructField("_found", ArrayType(LongType()))]

        def make(sent=sent, last=last) -> Callable:
            terms = sent.value

            def work(columns: list) -> list[tuple]:
                return [_finish(*row, terms, last, with_text) for row in zip(*columns)]

            return work

        state = scan(state if i == 0 else cut(state), make, StructType(fields))
    return state


def apart(near: list[tuple], rules: list[Span]) -> list[tuple]:
    """The spans (start, end, ..), sorted, that touch none of the rules' findings: one sweep over both."""
    taken: list[list[int]] = []
    for a, z in sorted(s[1:] for s in rules):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], z)
        else:
            taken.append([a, z])
    out, i = [], 0
    for x in near:
        while i < len(taken) and taken[i][1] <= x[0]:
            i += 1
        if i == len(taken) or x[1] <= taken[i][0]:
            out.append(x)
    return out


def _finish(doc_id: object, body: bytes, found: list | None, terms: dict, last: bool, with_text: bool) -> tuple:
    flat = list(found or [])
    for a, z, term in term_spans(body, terms) if terms else []:
        flat += (a, z, int(terms[term] >= 1))
    if not last:
        return doc_id, body, flat
    rules = rule_spans(body)
    near = apart(sorted(zip(flat[::3], flat[1::3], flat[2::3])), rules)
    every = to_code_points(body, rules + [("term", a, z) for a, z, _ in near])
    base = joined(every[: len(rules)], KINDS)
    count = Counter(s[0] for s in rules)
    row = (doc_id, *(count[k] for k in KINDS[:4]), digest(base), joined(every, KINDS))
    if not with_text:
        return row
    marks = [(a, z, b"[" + k.upper().encode() + b"]") for k, a, z in rules]
    marks += [(a, z, b"" if sure else b"[TERM]") for a, z, sure in near]
    return (*row, replace(body, marks).decode("utf-8", "replace"))


def op10_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    docs = documents(spark, sf_dir)
    return find(docs, disclosures(docs))
