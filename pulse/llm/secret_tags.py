"""Secret scans: a linear-chain conditional random field over tokens, beside fixed patterns.

The fixed patterns report assignments, access keys and long hexadecimal runs. The field tags
tokens as begin, inside or outside of a secret, from their shape and length, the words
before and after them, and features of the whole text; the best tagging is found by Viterbi.
Its secrets are added where no pattern reported one.

Every token of every text is scored and decoded. A token whose loss against "outside"
outweighs all that its transitions and a restart at its neighbour could gain is outside in
the best tagging, so Viterbi runs over the tokens between such ones only, with the same
result as over the whole text.

The field is trained here, by gradient steps on the likelihood with a prior around the
starting weights, on about ``PIECES`` pieces of the texts of about ``SAMPLE`` documents, both
chosen by hash over the whole table; the pattern matches serve as labels. A third of the
pieces holds secrets, a third holds numbers, codes or key words only, a third plain words.

Decoding rounds the weights to multiples of ``GRID``, so that sums are exact in any order and
equal taggings tie exactly; from the last token backwards, a tie takes outside before begin
before inside.

Defined cases: null text counts as empty; offsets are code points, ends exclusive; a table
without any match leaves the starting weights; rows repeat their results; an empty table
gives no rows; other columns are not looked at.
"""

import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.llm.columns import free_name
from pulse.session import shared_folder

SAMPLE = 2000  # documents
PIECES = 240  # for training
PIECE = 48  # tokens of a piece
TOKENS = 200_000  # tokens scored at a time
GRID = 2.0**-24  # of weights in decoding
CHARS = 1_000_000  # characters of a long text that are split into tokens at a time

# The patterns every scan must report, in this order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

KEY_WORDS = frozenset(
    "password passwd pwd secret token key apikey api_key credential bearer auth private".split()
)
_RUN = r"A-Za-z0-9+/_.\-"
_TOKEN = re.compile(rf"[{_RUN}]+=*|[^\W\d_]+|[^\s]")
_SPACE = re.compile(r"\s")

O, B, I = 0, 1, 2
SHAPES = ("word", "upper", "number", "mixed", "hex", "coded", "mark")
LENGTHS = (6, 12, 20, 32)
FEATURES = [
    "bias",
    *[f"shape {s}" for s in SHAPES],
    *[f"{s} of {n}" for s in ("mixed", "hex", "coded", "upper", "word") for n in range(1, 5)],
    "after key", "after sign", "after key and sign", "before mark", "after quote",
    "text has key", "text has much code",
]
_INDEX = {f: i for i, f in enumerate(FEATURES)}


def starting_weights():
    """Weights before training: (features, tags) and (tags, tags)."""
    w = np.zeros((len(FEATURES), 3))
    w[_INDEX["bias"], 1:] = -4.0
    for shape, value in (("word", -4), ("number", -2), ("mark", -4), ("upper", -2)):
        w[_INDEX[f"shape {shape}"], 1:] = value
    for n, value in ((2, 1.0), (3, 3.0), (4, 4.0)):
        for shape in ("mixed", "hex", "coded"):
            w[_INDEX[f"{shape} of {n}"], B] = value
            w[_INDEX[f"{shape} of {n}"], I] = value - 1
    w[_INDEX["after key and sign"], B] = 3.0
    w[_INDEX["after key"], B] = 1.0
    w[_INDEX["after sign"], B] = 0.5
    t = np.zeros((3, 3))
    t[O, I] = -8.0  # a secret cannot go on where none began
    t[B, B] = -1.0
    return w, t


def shape_of(token):
    """Class and length bucket of a token."""
    size = sum(len(token) >= n for n in LENGTHS)
    if token.isalpha():
        return ("upper" if token.isupper() and len(token) > 1 else "word"), size
    if token.isdigit():
        return "number", size
    core = token.rstrip("=")
    if len(core) >= 12 and re.fullmatch(r"[0-9a-f]+", core):
        return "hex", size
    if core.isalnum():
        return "mixed", size
    if len(core) > 1 and re.search(r"[A-Za-z]", core) and re.search(r"[0-9]", core):
        return "coded", size
    return "mark" if not core[:1].isalnum() else "word", size


def features_of(tokens, has_key, much_code):
    """Feature numbers of each token of a stretch."""
    out = []
    lowered = [t.lower() for t in tokens]
    for i, token in enumerate(tokens):
        shape, size = shape_of(token)
        f = ["bias", f"shape {shape}"]
        if f"{shape} of {size}" in _INDEX:
            f.append(f"{shape} of {size}")
        before = [t for t in lowered[max(0, i - 3) : i] if t not in "\"'`"]
        sign = bool(before) and before[-1] in (":", "=")
        if sign and len(before) > 1 and before[-2].rstrip("=") in KEY_WORDS:
            f.append("after key and sign")
        elif sign:
            f.append("after sign")
        elif before and before[-1].rstrip("=") in KEY_WORDS:
            # a key word and its sign may be one token
            f.append("after key and sign" if before[-1].endswith("=") else "after key")
        if i and tokens[i - 1] in "\"'`":
            f.append("after quote")
        if i + 1 < len(tokens) and tokens[i + 1] in "\"'`;":
            f.append("before mark")
        if has_key:
            f.append("text has key")
        if much_code:
            f.append("text has much code")
        out.append([_INDEX[x] for x in f])
    return out


def base_spans(text):
    """Pattern matches as (kind, start, end, start of the secret in it)."""
    spans = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= 6:
                spans.append((0, m.start(), m.end(), m.start(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                spans.append((1, m.start(), m.end(), m.start()))
    for m in HEX.finditer(text):
        spans.append((2, m.start(), m.end(), m.start()))
    return spans


def _about(text):
    """Features of a whole text."""
    low = text.lower()
    marks = sum(text.count(c) for c in "{}()[];=<>")
    return any(k in low for k in KEY_WORDS), marks * 50 > len(text)


def _on_grid(weights):
    return tuple(np.round(np.asarray(x) / GRID) * GRID for x in weights)


def viterbi(features, w, t):
    """The best tags of one stretch."""
    w, t = _on_grid((w, t))
    emission = np.array([w[f].sum(axis=0) for f in features])
    score, back = emission[0] + np.array([0.0, 0.0, -8.0]), []
    for e in emission[1:]:
        total = score[:, None] + t
        back.append(total.argmax(axis=0))
        score = total.max(axis=0) + e
    tags = [int(score.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def _split(text):
    """Tokens of a text in lists of bounded size; a token never spans a space."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + CHARS) if start + CHARS < len(text) else None
        end = cut.start() if cut else len(text)
        yield _TOKEN.findall(text, start, end)
        start = end


class Tagger:
    """A trained field over whole texts, many at a time."""

    def __init__(self, weights):
        self.w, self.t = _on_grid(weights)
        self.known = {}  # token -> class
        self.classes = {None: 0}  # class 0 stands between texts
        self.emission = [np.zeros(3)]
        self.flags = [(False,) * 6]
        # the most that three transitions can gain, none of the new ones from O to I
        others = np.delete(self.t.ravel(), O * 3 + I)
        self.gain = 3 * (self.t.max() - others.min())

    def _class(self, token):
        """Number of the token's class: what scores and neighbours need to know of it."""
        shape, size = shape_of(token)
        low = token.lower()
        flags = (
            low in (":", "="), low.rstrip("=") in KEY_WORDS, low.endswith("="),
            token in "\"'`", token in "\"'`;", True,
        )
        name = shape, size, flags
        if name not in self.classes:
            self.classes[name] = len(self.emission)
            score = self.w[_INDEX["bias"]] + self.w[_INDEX[f"shape {shape}"]]
            if f"{shape} of {size}" in _INDEX:
                score = score + self.w[_INDEX[f"{shape} of {size}"]]
            self.emission.append(score)
            self.flags.append(flags)
        return self.classes[name]

    def _codes(self, text):
        """Classes of a text's tokens."""
        parts = []
        for tokens in _split(text):
            if len(self.known) > 400_000:
                self.known.clear()
            codes = list(map(self.known.get, tokens))
            if None in codes:
                for i, code in enumerate(codes):
                    if code is None:
                        code = self.known.get(tokens[i])
                        if code is None:
                            code = self.known[tokens[i]] = self._class(tokens[i])
                        codes[i] = code
            parts.append(np.array(codes, np.int32))
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def _scores(self, codes, about):
        """Emissions of all tokens, with their context; ``about`` are features of the texts."""
        flags = np.array(self.flags)
        sign, key, ends, quote, closing, _ = (flags[:, k] for k in range(6))
        # the two nearest tokens of the three before that are no quotes; 0 for none
        p1, p2, p3 = (np.concatenate([np.zeros(k, np.int32), codes[: len(codes) - k]]) for k in (1, 2, 3))
        q1, q2, q3 = quote[p1], quote[p2], quote[p3]
        third = np.where(q3, 0, p3)
        last = np.where(~q1, p1, np.where(~q2, p2, third))
        second = np.where(~q1, np.where(~q2, p2, third), np.where(~q2, third, 0))
        assigned = np.where(sign[last], key[second], key[last] & ends[last])
        scores = np.array(self.emission)[codes]
        for name, where in (
            ("after key and sign", assigned),
            ("after sign", sign[last] & ~assigned),
            ("after key", key[last] & ~sign[last] & ~assigned),
            ("after quote", q1),
            ("before mark", closing[np.append(codes[1:], 0)]),
            ("text has key", about[:, 0]),
            ("text has much code", about[:, 1]),
        ):
            scores += where[:, None] * self.w[_INDEX[name]]
        return scores

    def _best(self, scores, first, last):
        """Best tags of a run of tokens; ``first``, ``last``: whether it is at an end of its text."""
        t = self.t.tolist()
        begin = (0.0, 0.0, -8.0) if first else t[O]
        at, back = [begin[y] + scores[0][y] for y in (O, B, I)], []
        for e in scores[1:]:
            step, new = [], []
            for y in (O, B, I):
                ways = [at[x] + t[x][y] for x in (O, B, I)]
                x = ways.index(max(ways))
                step.append(x), new.append(ways[x] + e[y])
            back.append(step)
            at = new
        if not last:
            at = [at[x] + t[x][O] for x in (O, B, I)]
        tags = [at.index(max(at))]
        for step in reversed(back):
            tags.append(step[tags[-1]])
        return tags[::-1]

    def _found(self, codes, about):
        """Secrets as (first token, token after the last), over all texts in ``codes``."""
        scores = self._scores(codes, about)
        loss = scores[:, O] - scores[:, 1:].max(axis=1)
        after = np.append(scores[1:, I] - scores[1:, B], 0.0)
        open_tokens = np.flatnonzero((loss <= self.gain + np.maximum(after, 0) + 1e-6) & (codes > 0))
        if not len(open_tokens):
            return []
        found = []
        for run in np.split(open_tokens, np.flatnonzero(np.diff(open_tokens) > 1) + 1):
            start, end = int(run[0]), int(run[-1]) + 1
            tags = self._best(scores[start:end].tolist(), codes[start - 1] == 0, codes[end] == 0)
            i = 0
            while i < len(tags):
                j = i + 1
                if tags[i] != O:
                    while j < len(tags) and tags[j] == I:
                        j += 1
                    found.append((start + i, start + j))
                i = j
        return found

    def tagged(self, texts):
        """Per text the field's secrets, as (first token, token after the last)."""
        out = [[] for _ in texts]
        codes, about, owners, size = [], [], [], 0

        def flush():
            nonlocal size
            if owners:
                between = np.zeros(3, np.int32)
                starts, parts, marks, at = [], [], [], 0
                for c, a in zip(codes, about):
                    starts.append(at + 3)
                    parts += [between, c]
                    marks.append(np.broadcast_to(np.array(a), (len(c) + 3, 2)))
                    at += len(c) + 3
                parts.append(between)
                marks.append(np.zeros((3, 2), bool))
                for a, b in self._found(np.concatenate(parts), np.concatenate(marks)):
                    k = bisect_right(starts, a) - 1
                    out[owners[k]].append((a - starts[k], b - starts[k]))
            codes.clear(), about.clear(), owners.clear()
            size = 0

        for n, text in enumerate(texts):
            if text:
                codes.append(self._codes(text)), about.append(_about(text)), owners.append(n)
                size += len(codes[-1])
                if size > TOKENS:
                    flush()
        flush()
        return out

    def spans_of(self, texts):
        """Per text all spans as (kind, start, end), the patterns' and the field's."""
        out = []
        for text, secrets in zip(texts, self.tagged(texts)):
            text = text or ""
            base = base_spans(text)
            spans = [s[:3] for s in base]
            if secrets:
                wanted = {k for a, b in secrets for k in (a, b - 1)}
                places = {k: m.span() for k, m in enumerate(_TOKEN.finditer(text)) if k in wanted}
                for a, b in secrets:
                    start, end = places[a][0], places[b - 1][1]
                    if not any(start < s[2] and s[1] < end for s in base):
                        spans.append((3, start, end))
            out.append(sorted(spans, key=lambda s: (s[1], s[0], s[2])))
        return out

    def spans(self, text):
        return self.spans_of([text])[0]


def training_pieces(text):
    """Pieces of a text as (class, features, tags); tags come from the patterns.

    Class 2 holds a secret, class 1 a number, code or key word but no secret, class 0 neither.
    """
    base, about = base_spans(text), _about(text)
    matches = list(_TOKEN.finditer(text))
    tokens = [m.group() for m in matches]
    tags, at = [], 0
    base.sort(key=lambda s: s[2])
    for m in matches:
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        inside = [s for s in base[at : at + 4] if s[3] < m.end() and m.start() < s[2]]
        if not inside:
            tags.append(O)
        else:
            tags.append(I if tags and tags[-1] != O and m.start() > inside[0][3] else B)
    for start in range(0, len(tokens), PIECE):
        end = min(start + PIECE, len(tokens))
        before = min(start, 3)
        features = features_of(tokens[start - before : end + 1], *about)[before:][: end - start]
        if any(tags[start:end]):
            kind = 2
        else:
            kind = int(any(
                t.lower() in KEY_WORDS or shape_of(t)[0] not in ("word", "mark") for t in tokens[start:end]
            ))
        yield kind, features, tags[start:end]


def train(examples, rounds=40, rate=0.1, hold=0.01):
    """Weights by gradient steps on the mean log likelihood; ``hold`` ties them to the start."""
    w0, t0 = starting_weights()
    w, t = w0.copy(), t0.copy()
    if not examples:
        return w, t
    size_w, size_t = np.zeros_like(w), np.zeros_like(t)
    first = np.array([0.0, 0.0, -8.0])
    for _ in range(rounds):
        grad_w, grad_t = np.zeros_like(w), np.zeros_like(t)
        for features, tags in examples:
            e = np.array([w[f].sum(axis=0) for f in features])
            n = len(e)
            alpha, beta = np.zeros((n, 3)), np.zeros((n, 3))
            alpha[0] = e[0] + first
            for i in range(1, n):
                alpha[i] = e[i] + np.logaddexp.reduce(alpha[i - 1][:, None] + t, axis=0)
            for i in range(n - 2, -1, -1):
                beta[i] = np.logaddexp.reduce(t + (e[i + 1] + beta[i + 1])[None, :], axis=1)
            z = np.logaddexp.reduce(alpha[-1])
            node = np.exp(alpha + beta - z)
            node[np.arange(n), tags] -= 1
            for i, f in enumerate(features):
                grad_w[f] -= node[i]
            for i in range(1, n):
                pair = alpha[i - 1][:, None] + t + (e[i] + beta[i])[None, :] - z
                grad_t -= np.exp(pair)
                grad_t[tags[i - 1], tags[i]] += 1
        grad_w = grad_w / len(examples) - hold * (w - w0)
        grad_t = grad_t / len(examples) - hold * (t - t0)
        size_w += grad_w**2
        size_t += grad_t**2
        w += rate * grad_w / np.sqrt(size_w + 1e-8)
        t += rate * grad_t / np.sqrt(size_t + 1e-8)
    t[O, I] = -8.0
    return w, t


def _share(wanted, of):
    """Condition that keeps about ``wanted`` of ``of`` rows by a hash that all columns enter."""
    share = min(1.0, wanted / of) if of else 0.0
    return lambda *columns: F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < int(share * (1 << 40))


def learn(docs, sample=SAMPLE):
    """Weights from the pieces of about ``sample`` documents, chosen by hash.

    The pieces are written down; the driver gets about ``PIECES`` of them.
    """
    spark = docs.sparkSession
    rows = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    chosen = rows.where(_share(sample, rows.count())("doc_id"))
    pieces = map_arrow(
        chosen, _training_parts,
        "doc_id bigint, part int, kind int, features array<array<int>>, tags array<int>",
    )
    folder = shared_folder(spark, "pieces")
    pieces.write.parquet(folder)
    pieces = spark.read.parquet(folder)
    taken = F.lit(False)
    for kind, n in pieces.groupBy("kind").count().collect():
        taken = taken | ((F.col("kind") == kind) & _share(PIECES // 3, n)("doc_id", "part"))
    examples = pieces.where(taken).select("doc_id", "part", "features", "tags").collect()
    examples.sort(key=lambda r: (r["doc_id"], r["part"], r["tags"]))
    return train([(r["features"], r["tags"]) for r in examples])


def _training_parts(batches, schema):
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = [(i, part, *piece) for part, piece in enumerate(training_pieces(text or ""))]
            yield record_batch(schema, [list(c) for c in zip(*rows)] if rows else [[]] * 5)


def _tag(weights):
    def run(batches, schema):
        tagger = Tagger(weights)
        for batch in batches:
            spans = tagger.spans_of(batch.column(1).to_pylist())
            yield record_batch(
                schema,
                [
                    batch.column(0).to_pylist(),
                    [
                        [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s]
                        for s in spans
                    ],
                ],
            )

    return run


def find_secrets(docs, weights=None):
    """``doc_id, spans`` for every row; spans by start, then kind."""
    weights = learn(docs) if weights is None else weights
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return map_arrow(
        rows, _tag([np.asarray(x).tolist() for x in weights]),
        "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>",
    )


def mask_secrets(docs, weights=None, mark="[SECRET]"):
    """``docs`` with every span of its texts replaced by ``mark``; ``n_chars`` follows the text."""
    import pandas as pd

    from pulse.llm.arrow import bound_batches

    weights = learn(docs) if weights is None else weights
    plain = [np.asarray(x).tolist() for x in weights]

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        tagger = Tagger(plain)
        out = []
        texts = texts.tolist()
        for text, spans in zip(texts, tagger.spans_of(texts)):
            if text:
                parts, at = [], 0
                for _, a, b in spans:
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                text = "".join(parts) + text[at:] if parts else text
            out.append(text)
        return pd.Series(out, dtype=object)

    bound_batches(docs.sparkSession)
    names = docs.columns
    mask = free_name(docs, "masked")
    found = docs.withColumn(mask, masked(F.col("text").cast("string")))
    new = {"text": F.col(mask), "n_chars": F.length(mask).cast("long")}
    return found.select(*[new.get(c, F.col(c)).alias(c) for c in names])


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return find_secrets(docs).select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
