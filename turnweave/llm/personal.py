"""Personal data by weak supervision.

Base spans come from one pattern for each kind. Where a base pattern runs on over its neighbours (a phone number with a card
number right behind it is one long run of digits) or the writing is unusual, the base finds nothing. So tighter and wider
candidates are collected as well, and labelers vote on each: a strict pattern, a check of digits or ranges, gazetteers (top
domains, issuer prefixes, calling codes, reserved nets), words before it that speak for or against its kind, and its edges. Expectation
maximisation over all documents' votes estimates how reliable each labeler is for each kind, without any true label; its posteriors
train a logistic span classifier, which decides on the candidates that no base span covers. Base spans always stay. Secrets (passwords,
tokens, keys) have no base: all their spans are candidates, from what they are assigned to, from their known beginnings, and from their length;
a secret of any length is one span, so nothing of it is left when spans are masked.

Words speak for or against a candidate within the CONTEXT (40) characters before it. Candidates of digits are sought in zones, stretches of text in which two digits
are at most 100 characters apart, and ZONE_EDGE (45) characters around them: more than any candidate's part without digits.

What is gathered from the corpus is a count for each distinct pattern of votes and features: their number is bounded by
the product of a few small value sets, not by the corpus, and partial counts are summed before and after one small shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.lineage import small_batches
from turnweave.llm.toxicity import _logistic, _sigmoid

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
THRESHOLD = 0.9
EM_STEPS = 60
TEXT_BYTES = 1 << 19
CONTEXT = 40  # characters before a candidate in which words count

# Patterns of the base, written so that no start is tried twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Candidates beyond the base.
_WIDER = re.compile(
    r"(?P<card>(?<![0-9A-Za-z.+-])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|3[47][0-9]{2}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z]))"
    r"|(?P<phone>(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]))"
    r"|(?P<ip>(?<![0-9A-Za-z.:])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})(?![0-9A-Za-z:]))"
)
# Candidates have digits; zones of digits lie further apart than the longest stretch of one without.
_ZONE = re.compile(r"[0-9](?:[^0-9]{0,100}+[0-9])*+")
ZONE_EDGE = 45
_SPELT = re.compile(r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({<](?:at|@)[\])}>]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({<](?:dot|\.)[\])}>]\x20?)[A-Za-z0-9-]{1,63})+")
_SPELT_SIGNS = tuple(bracket + at for bracket in "[({<" for at in ("at", "@"))  # _SPELT needs one, in any case

# A secret: what a name of one is set to, a run with a known beginning, a long run of hexadecimal digits, a private key.
_SECRET_NAMES = ("token", "secret", "passw", "pwd", "api_key", "api-key", "apikey", "access_key", "access-key", "credential")
_ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|(?:api|access)[_-]?key|credential)s?[\"']?\x20{0,3}[:=]\x20{0,3}[\"']?(?P<secret>[A-Za-z0-9+/_.=~-]{8,}+)")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[0-9A-Fa-f]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{5,}+)(?![A-Za-z0-9+/_-])")
_PRIVATE = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[^-]++-----END [A-Z ]{0,30}PRIVATE KEY-----")
_BEGINNINGS = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|AIza|eyJ|-----BEGIN")
RUN = 20  # characters of the shortest run that can be a secret by itself

# Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov mil info biz io de fr es uk eu us ca ch at it nl be pt pl se no dk fi ie in jp cn br mx ar cl co au nz ru za".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65")
FOR = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|kontakt|correo|courriel|write|schreib\w*)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|ipv[46]|address|adresse|host|server|client|login|dirección)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|payment|pan)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|téléphone|teléfono|handy|móvil|whatsapp|sms)\b"),
    "secret": re.compile(r"(?i)(?:token|secret|passw|pwd|key|credential|auth|login|geheim|passwort|contraseña|mot de passe)"),
}
AGAINST = re.compile(r"(?i)\b(?:order|invoice|isbn|issn|version|release|build|serial|item|article|page|chapter|section|ticket|tracking|bestellung|rechnung|facture|pedido|factura|doi|number of|nr|sha(?:1|256|512)?|md5|checksum|digest|commit|hash|etag)\b")

_SIGN = np.zeros(256, bool)
_SIGN[[*range(48, 58), *b"@[({<=:"]] = True
_RUNS = np.zeros(256, bool)
_RUNS[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-"]] = True
N_VOTES = 6
_SHAPES = 6
_EDGES = 4


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c)
        total += x if k % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base, by kind, then start."""
    out = []
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append((0, start, end))
        at = max(at + 1, end)
    for m in _DOTTED.finditer(text) if "." in text else ():
        if m[0].count(".") >= 3:
            parts, start = m[0].split("."), m.start()
            for k in range(0, len(parts) - 3, 4):  # the pattern's matches follow one another in a run of dotted numbers
                four = parts[k : k + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    out.append((1, start, end))
                start = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def candidates(text: str, long_run: bool = True) -> list[tuple[int, int, int]]:
    """(kind, start, end) beyond the base's patterns: leftmost, a card before a phone before an address; secrets first. `long_run`: whether the text
    has a run of RUN characters that secrets are made of, if that is known."""
    out = []
    for zone in _ZONE.finditer(text):
        for m in _WIDER.finditer(text, max(0, zone.start() - ZONE_EDGE), zone.end() + ZONE_EDGE):
            out.append((KINDS.index(m.lastgroup), m.start(), m.end()))
    low = text.lower()
    if any(sign in low for sign in _SPELT_SIGNS):
        out += [(0, m.start(), m.end()) for m in _SPELT.finditer(text)]
    secrets = []
    if any(name in low for name in _SECRET_NAMES):
        secrets += [(m.start("secret"), m.end("secret")) for m in _ASSIGNED.finditer(text)]
    if long_run:
        secrets += [(m.start(), m.end()) for m in _RUN.finditer(text)]
        secrets += [(m.start(), m.end()) for m in _PRIVATE.finditer(text)] if "PRIVATE KEY" in text else []
    end, kept = -1, []
    for s, e in sorted(secrets, key=lambda x: (x[0], -x[1])):
        if s >= end:
            kept.append((4, s, e))
            end = e
    return kept + out


def _edge(c: str) -> int:
    return 0 if c == "" or c.isspace() else 1 if c in ".,;:!?()[]<>\"'" else 3 if c.isalnum() else 2


def code(text: str, kind: int, start: int, end: int) -> int:
    """A candidate's votes and features as one number."""
    span = text[start:end]
    digits = _digits(span)
    name = KINDS[kind]
    before = text[max(0, start - CONTEXT) : start]
    left, right = _edge(text[start - 1 : start]), _edge(text[end : end + 1])
    if name == "email":
        local, _, domain = span.partition("@")
        labels = domain.split(".")
        plain = bool(domain) and not re.search(r"[\[({<\x20]", span)
        strict = 1 if plain and not local.startswith(".") and ".." not in local else 0 if not plain else -1
        tail = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        check = 1 if not plain or all(x and x[0] != "-" and x[-1] != "-" for x in labels) else -1
        known = 1 if tail in TOP_DOMAINS else 0 if tail.isalpha() and len(tail) > 1 else -1
        shape = min(len(labels), 4) if plain else 5
    elif name == "ip":
        parts = span.split(".")
        if len(parts) == 4:
            right_form = all(p == "0" or p[:1] != "0" for p in parts)
            strict = 1 if right_form else -1
            check = 1 if all(len(p) <= 5 and int(p) <= 255 for p in parts) else -1
            first = int(parts[0][:5])
            known = 1 if 0 < first < 224 and first != 127 else -1
            shape = sum(len(p) > 1 for p in parts)
        else:
            strict, check, known, shape = 1, 1, 1 if re.match(r"(?i)2|fe80|fc|fd", span) else 0, 5
    elif name == "card":
        grouped = re.fullmatch(r"[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4}){2}", span)
        strict = 1 if grouped or len(span) == len(digits) in (15, 16) else 0 if len(span) == len(digits) else -1
        check = 1 if _luhn(digits) else -1
        known = 1 if ISSUERS.match(digits) else -1
        shape = 0 if grouped else min(5, max(1, len(digits) - 12)) if len(digits) <= 16 else 5
    elif name == "secret":
        hexadecimal = re.fullmatch(r"[0-9A-Fa-f]+", span) is not None
        strict = 1 if hexadecimal and len(span) in (32, 40, 48, 56, 64, 96, 128) or not hexadecimal and len(span) >= 20 else 0 if len(span) >= 12 else -1
        mixed = sum((any(c.isdigit() for c in span), any(c.islower() for c in span), any(c.isupper() for c in span)))
        check = 1 if mixed > 1 and len(set(span)) >= 8 else -1
        known = 1 if _BEGINNINGS.match(span) else 0 if digits else -1
        shape = 0 if hexadecimal else min(5, 1 + len(span) // 12)
    else:
        plus = span[0] == "+"
        strict = 1 if plus and 10 <= len(digits) <= 13 else 0 if 9 <= len(digits) <= 11 and re.search(r"[\x20().-]", span) else -1
        check = 1 if 9 <= len(digits) <= 14 else -1
        known = (1 if any(digits[:k] in CALLING_CODES for k in (1, 2)) else -1) if plus else 0
        shape = 2 * plus + ("(" in span) + (2 if span.count("-") > 1 else 0)
    votes = (strict, check, known, 1 if FOR[name].search(before) else 0, -1 if AGAINST.search(before) else 0, -1 if 3 in (left, right) else 1 if left < 2 and right < 2 else 0)
    out = kind
    for v in votes:
        out = out * 3 + v + 1
    return ((out * _SHAPES + min(shape, _SHAPES - 1)) * _EDGES + left) * _EDGES + right


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of codes: kinds, votes (0 against, 1 none, 2 for) and rows of 0/1 features for the span classifier."""
    x = codes.astype(np.int64)
    x, right = np.divmod(x, _EDGES)
    x, left = np.divmod(x, _EDGES)
    x, shape = np.divmod(x, _SHAPES)
    votes = np.zeros((len(codes), N_VOTES), np.int64)
    for j in reversed(range(N_VOTES)):
        x, votes[:, j] = np.divmod(x, 3)
    kind = x
    one = lambda v, n: np.eye(n)[v]
    k = len(KINDS)
    parts = [one(kind, k), one(kind * _SHAPES + shape, k * _SHAPES), one(left, _EDGES), one(right, _EDGES)]
    parts += [one(kind * 3 + votes[:, j], 3 * k) for j in range(N_VOTES)]
    return kind, votes, np.concatenate(parts, axis=1) if len(codes) else np.zeros((0, k + k * _SHAPES + 2 * _EDGES + 3 * k * N_VOTES))


def reliabilities(votes: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation for one kind: posteriors of the vote patterns, how each labeler votes on false and on true
    spans, and the share of true ones. Begins with the votes' balance; a weak prior says that labelers tend to be right."""
    prior = np.array([[0.5, 0.35, 0.15], [0.1, 0.35, 0.55]])[:, None, :] * 10 * np.ones((2, N_VOTES, 1))
    balance = (votes - 1).sum(1)
    post = np.clip(0.5 + 0.2 * balance, 0.02, 0.98)
    theta, share = prior / prior.sum(2, keepdims=True), 0.5
    for _ in range(steps):
        share = ((post * counts).sum() + 2) / (counts.sum() + 4)
        for z, w in ((0, (1 - post) * counts), (1, post * counts)):
            for j in range(N_VOTES):
                got = np.bincount(votes[:, j], w, minlength=3) + prior[z, j]
                theta[z, j] = got / got.sum()
        log = np.log(theta)
        each = [log[z, np.arange(N_VOTES)[None, :], votes].sum(1) for z in (0, 1)]
        post = _sigmoid(each[1] - each[0] + np.log(share / (1 - share)))
    return post, theta, share


def train(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights of the span classifier, the constant last, from counted candidates."""
    kind, votes, x = unpack(codes)
    if len(codes) == 0:
        return np.append(np.zeros(x.shape[1]), -10.0)
    post = np.zeros(len(codes))
    for k in range(len(KINDS)):
        mine = kind == k
        if mine.any():
            post[mine], _, _ = reliabilities(votes[mine], counts[mine].astype(np.float64))
    return _logistic(x, post, np.sqrt(counts.astype(np.float64)), ridge=0.3)


def _worth(texts: pa.Array) -> tuple[list[bool], list[bool]]:
    """Which texts have a digit, an @, a sign that sets a value or a word in brackets, without which there is no span, or a run of RUN characters
    that secrets are made of; and which have such a run."""
    data, offs = R.buffer(texts)
    hit = np.append(0, np.cumsum(_SIGN[data]))[offs]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _RUNS[data]
    begins, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)  # runs, over the borders of texts too
    cuts = np.unique(np.concatenate([offs, begins, ends]))
    size = np.diff(cuts)
    long_at = cuts[:-1][(size >= RUN) & (inside[1:-1][np.minimum(cuts[:-1], len(data) - 1)] == 1)] if len(data) else cuts[:0]
    long = np.searchsorted(long_at, offs[1:]) > np.searchsorted(long_at, offs[:-1])
    return ((hit[1:] > hit[:-1]) | long).tolist(), long.tolist()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[int] = Counter()
    for batch in R.chunks(batches, "text", TEXT_BYTES):
        for text, worth, run in zip(batch.column("text").to_pylist(), *_worth(batch.column("text")), strict=True):
            if worth:
                seen.update(code(text, *span) for span in {*base_spans(text), *candidates(text, run)})
    yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])


def all_spans(text: str, weights: np.ndarray, known: dict[int, float], threshold: float = THRESHOLD, long_run: bool = True) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and all spans by kind, then start: the base's and the candidates that the classifier takes."""
    base = base_spans(text)
    more = []
    taken = sorted((s, e) for _, s, e in base)
    for kind, s, e in candidates(text, long_run):
        if any(a < e and s < b for a, b in taken):
            continue
        c = code(text, kind, s, e)
        if c not in known:
            known[c] = float(_sigmoid(unpack(np.array([c]))[2] @ weights[:-1] + weights[-1])[0])
        if known[c] >= threshold:
            more.append((kind, s, e))
            taken.append((s, e))
    return base, sorted(base + more)


def _found(weights: np.ndarray, threshold: float, mask: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, float] = {}
        for batch in R.chunks(batches, "text", TEXT_BYTES):
            at = batch.schema.get_field_index("text")
            texts, spans, bases = batch.column(at).to_pylist(), [], []
            for k, (worth, run) in enumerate(zip(*_worth(batch.column(at)), strict=True)):
                text = texts[k]
                base, found = all_spans(text, weights, known, threshold, run) if worth else ([], [])
                bases.append([{"kind": KINDS[x], "start": s, "end": e} for x, s, e in base])
                spans.append([{"kind": KINDS[x], "start": s, "end": e} for x, s, e in found])
                if mask and found:
                    texts[k] = masked(text, found)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            arrays = [pa.array(texts, pa.string()) if mask and name == "text" else batch.column(name) for name in batch.schema.names if mask or name != "text"]
            names = [name for name in batch.schema.names if mask or name != "text"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(bases, kind), pa.array(spans, kind)], names=[*names, "base_spans", "spans"])

    return run


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The span classifier's weights, from the votes on all candidates of all documents."""
    counts = small_batches(docs).select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counted, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    return train(counts.column("code").to_numpy(), counts.column("n").to_numpy())


_LIST = "array<struct<kind:string,start:bigint,end:bigint>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, base_spans and spans (arrays of kind, start, end in code points, by kind and start).

    Null and empty texts have no spans. Repeated rows give the same spans; a null id stays null. Other columns are not
    carried. Without any candidate in the corpus the classifier takes none. Two passes over the texts, no shuffle of them.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return small_batches(rows).mapInArrow(_found(fit(rows), threshold, False), f"doc_id {kind}, base_spans {_LIST}, spans {_LIST}")


def mask(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with each span in `text_col` replaced by its kind in angle brackets; null texts stay null. Other columns, whatever
    their names, are as they were."""
    names = docs.columns
    inner = docs.select(*(F.col(f"`{c}`").alias("text" if c == text_col else f"c{k}") for k, c in enumerate(names)))
    fields = ", ".join(f"{c} {t}" for c, t in inner.dtypes)
    out = inner.mapInArrow(_found(fit(docs, text_col), threshold, True), f"{fields}, base_spans {_LIST}, spans {_LIST}")
    return out.select(*(F.col("text" if c == text_col else f"c{k}").alias(c) for k, c in enumerate(names)))


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    say = lambda spans: ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans)
    for batch in batches:
        base, spans = batch.column("base_spans").to_pylist(), batch.column("spans").to_pylist()
        counts = [pa.array([sum(x["kind"] == kind for x in row) for row in base], pa.int64()) for kind in BASE_KINDS]
        shas = pa.array([hashlib.sha256(say(row).encode()).hexdigest() for row in base], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, shas, pa.array([say(row) for row in spans], pa.string()), pa.array([len(row) for row in spans], pa.int64()), pa.array([sum(x["kind"] == "secret" for x in row) for row in spans], pa.int64())], names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans", "n_secret"])


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the base's counts n_email, n_ip, n_card, n_phone, base_sha256, all spans as kind:start:end, comma-joined, and their number
    and that of the secrets among them."""
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(_told, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in BASE_KINDS) + ", base_sha256 string, spans string, n_spans bigint, n_secret bigint")
