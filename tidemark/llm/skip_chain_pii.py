"""Personal data by patterns and a skip-chain conditional random field.

Four patterns find what is certain: e-mail and IP addresses, card numbers that pass the
Luhn test, international phone numbers. A field over the tokens of a document then labels what
they leave: the same number without its plus sign, an account named without its host. Tokens
with nothing but white space between them share a chain potential; tokens of one document that are equal or have the
same digits or account, however far apart, share a skip potential that favours one label (each is joined with
the next of its kind, so edges are linear in tokens). Tokens in a pattern's
span keep its label; loopy message passing carries it along the edges. A run of tokens with one
label is added, as a `..._mention`, if a skip path joins one of them with a pattern's span of that kind.

Words without a digit or an at sign that name no account of their document are observed as outside
all entities: they send constant messages, so the field is solved on the other tokens alone.

The weights are learned from the patterns' own labels in all documents, by pseudo-likelihood: Spark counts how
often each combination of token features and neighbour labels occurs, and the driver
fits the combinations, of which there are few. Tokens joined by a skip edge with a span of
the patterns, but outside one, count as unlabelled there.
"""

import re
import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.llm.shared import slices, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ["email", "ip", "card", "phone"]
MENTION = "_mention"
OUTSIDE, UNKNOWN = 0, len(KINDS) + 1
LABELS = len(KINDS) + 1
#: Combinations of features and neighbours that the fit takes at most, the most frequent ones.
MOST_COMBINATIONS = 20_000
#: The skip potential that the fit is drawn to; patterns leave little to learn it from.
SKIP = 6.0
PENALTY = 1e-4
STEPS = 400
ROUNDS = 12
DAMPING = 0.5
#: Least posterior of an added token.
CERTAIN = 0.5

# The patterns of the four kinds. A run that cannot begin a match is left as a
# whole, so time is linear in the text.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = re.compile(rf"{LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
FIRST_EMAIL = re.compile(rf"(?<!{LOCAL}){EMAIL.pattern}")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"\S+")
MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
EDGES = ".,;:!?\"'%$#*<>[]{}"
SHORTEST_KEY, SHORTEST_NUMBER = 5, 7
DIGIT_COUNTS = [1, 3, 4, 5, 7, 8, 9, 13, 20]
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("base", pa.bool_())]))
SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def digits_of(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(digits):
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text):
    """Matches from the left, none overlapping. Behind one, its last run of letters may go on."""
    found, end = [], 0
    while True:
        match = EMAIL.match(text, end) if found else None
        match = match or FIRST_EMAIL.search(text, end)
        if not match:
            return found
        found.append(match.span())
        end = match.end()


def base_spans(text):
    """(kind number, start, end) of all spans that the patterns find, by kind, then start."""
    found = [(0, *span) for span in emails(text)] if "@" in text else []
    found += [(1, *m.span()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for match in CARD.finditer(text):
        number = digits_of(match[0])
        if 13 <= len(number) <= 19 and luhn(number):
            found.append((2, *match.span()))
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def features(token, core, before, after):
    """The features of a token as the bits of a number."""
    digits = digits_of(core)
    parts = core.split(".")
    dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    flags = [
        True, "@" in core, bool(EMAIL.fullmatch(core)), any(c.isalpha() for c in core),
        core.isascii() and core.isdigit(), "-" in core, "." in core, dotted,
        dotted and all(len(p) < 4 and int(p) <= 255 for p in parts), core.startswith("+"),
        "(" in token or ")" in token, 13 <= len(digits) <= 19 and luhn(digits),
        before is not None, after is not None, bool(before) and before.startswith("+"),
        *[i == bisect_right(DIGIT_COUNTS, len(digits)) for i in range(len(DIGIT_COUNTS) + 1)]]
    return sum(1 << i for i, flag in enumerate(flags) if flag)


N_FEATURES = 15 + len(DIGIT_COUNTS) + 1


def keys_of(core):
    """What a token shares with those that skip edges join it with."""
    lower = core.strip("()").lower()
    keys = {("same", lower), ("account", lower)} if len(lower) >= SHORTEST_KEY else set()
    digits = digits_of(core)
    if len(digits) >= SHORTEST_NUMBER:
        keys.add(("digits", digits))
    account, at, _ = lower.partition("@")
    if at and len(account) >= SHORTEST_KEY:
        keys.add(("account", account))
    return keys


class Field:
    """The field of one document: its tokens, edges and what the patterns know."""

    def __init__(self, text):
        self.base = base_spans(text)
        accounts = {text[a:b].partition("@")[0].lower() for kind, a, b in self.base if kind == 0}
        accounts = {a for a in accounts if len(a) >= SHORTEST_KEY}
        spans = [m.span() for m in MARKED.finditer(text)]
        if accounts:
            spans = sorted({*spans, *(m.span() for m in TOKEN.finditer(text)
                                      if m[0].strip(EDGES).lower() in accounts)})
        tokens = [text[a:b] for a, b in spans]
        self.cores = []
        for (a, b), token in zip(spans, tokens):
            core = token.strip(EDGES)
            begin = a + len(token) - len(token.lstrip(EDGES)) if core else a
            self.cores.append((begin, begin + len(core) if core else b))
        n = len(spans)
        joined = [spans[i][1] == self.cores[i][1] and spans[i + 1][0] == self.cores[i + 1][0]
                  and text[spans[i][1]:spans[i + 1][0]].isspace() for i in range(n - 1)]
        self.chain = [(i, i + 1) for i in range(n - 1) if joined[i]]
        self.features = [features(
            tokens[i], text[slice(*self.cores[i])],
            tokens[i - 1] if i and joined[i - 1] else None,
            tokens[i + 1] if i + 1 < n and joined[i] else None) for i in range(n)]
        last, skip = {}, set()
        for i in range(n):
            for key in keys_of(text[slice(*self.cores[i])]):
                if key in last:
                    skip.add((last[key], i))
                last[key] = i
        self.skip = sorted(skip)
        starts = [a for a, _ in spans]
        self.known = [OUTSIDE] * n
        for kind, a, b in reversed(self.base):  # kinds listed first come last
            for i in range(max(bisect_right(starts, a) - 1, 0), n):
                if starts[i] >= b:
                    break
                if spans[i][1] > a:
                    self.known[i] = kind + 1

    def skip_groups(self):
        """Kinds of the patterns that skip paths join each token with."""
        root = list(range(len(self.known)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i
        for i, j in self.skip:
            root[find(j)] = find(i)
        kinds = {}
        for i, label in enumerate(self.known):
            if label:
                kinds.setdefault(find(i), set()).add(label)
        return [kinds.get(find(i), set()) for i in range(len(root))]

    def combinations(self):
        """(features, left label, right label, skip labels, label) of every labelled token."""
        n = len(self.known)
        beside = [[] for _ in range(n)]
        for i, j in self.skip:
            beside[i].append(j)
            beside[j].append(i)
        hidden = [not self.known[i] and any(self.known[j] for j in beside[i]) for i in range(n)]
        seen = [UNKNOWN if hidden[i] else self.known[i] for i in range(n)]
        left, right = [OUTSIDE] * n, [OUTSIDE] * n
        for i, j in self.chain:
            left[j], right[i] = seen[i], seen[j]
        for i in range(n):
            if not hidden[i]:
                labels = [seen[j] for j in beside[i]]
                yield (self.features[i], left[i], right[i],
                       [labels.count(y) for y in range(LABELS)], self.known[i])


def bits_of(masks):
    return (np.asarray(masks, np.int64)[:, None] >> np.arange(N_FEATURES) & 1).astype(float)


def log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(masks, left, right, beside, labels, counts):
    """Weights of maximal pseudo-likelihood under a Gaussian prior: features, chain, skip."""
    weights = {"features": np.zeros((N_FEATURES, LABELS)), "chain": np.zeros((LABELS, LABELS)),
               "skip": np.where(np.arange(LABELS) == OUTSIDE, 0.0, SKIP)}
    if not len(labels):
        return weights
    prior = {name: w.copy() for name, w in weights.items()}
    x = bits_of(masks)
    share = np.asarray(counts, float) / np.sum(counts)
    one = np.eye(LABELS + 1)[:, :LABELS]  # an unknown label has no weight
    before, after, beside = one[left], one[right], np.asarray(beside, float)
    truth = one[labels]
    first = {name: np.zeros_like(w) for name, w in weights.items()}
    second = {name: np.zeros_like(w) for name, w in weights.items()}
    for step in range(1, STEPS + 1):
        score = (x @ weights["features"] + before @ weights["chain"]
                 + after @ weights["chain"].T + beside * weights["skip"])
        gap = (np.exp(score - log_sum(score, 1)[:, None]) - truth) * share[:, None]
        slope = {"features": x.T @ gap, "chain": before.T @ gap + gap.T @ after,
                 "skip": (gap * beside).sum(0)}
        slope["skip"][OUTSIDE] = 0.0  # only entities draw their likes
        for name, w in weights.items():
            g = slope[name] + PENALTY * (w - prior[name])
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            w -= 0.1 * (first[name] / (1 - 0.9 ** step)) / (
                np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-9)
    return weights


def learn(docs, most=MOST_COMBINATIONS):
    """The field's weights from the labels of the patterns in all of `docs`."""
    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                found = [c for text in texts.filter(
                    pc.match_substring_regex(texts, "[0-9@]")).to_pylist()
                    for c in Field(text).combinations()]
                names = ["mask", "before", "after", "beside", "label"]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[i] for c in found], kind) for i, kind in enumerate(kinds)], names)

    seen = texts_of(docs).select("text").mapInArrow(
        rows, "mask bigint, before int, after int, beside array<int>, label int")
    keys = ["mask", "before", "after", "beside", "label"]
    common = (seen.groupBy(*keys).agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), *keys).limit(most).collect())
    return fit(*[[row[c] for row in common] for c in [*keys, "n"]])


def marginals(unary, edges, potentials, rounds=ROUNDS):
    """Posteriors of all nodes by loopy sum-product messages; exact where edges form no loop.

    `potentials[e]` is indexed by the labels of the first and the second end of edge e.
    """
    n_labels = unary.shape[1]
    if len(edges):
        ends = np.asarray(edges)
        source = np.concatenate([ends[:, 0], ends[:, 1]])
        target = np.concatenate([ends[:, 1], ends[:, 0]])
        pair = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(ends))
        messages = np.zeros((len(source), n_labels))
    belief = unary
    for _ in range(rounds if len(edges) else 0):
        out = (belief[source] - messages[back])[:, :, None] + pair
        new = log_sum(out, 1)
        new -= log_sum(new, 1)[:, None]
        messages = DAMPING * messages + (1 - DAMPING) * new
        belief = unary.copy()
        np.add.at(belief, target, messages)
    return np.exp(belief - log_sum(belief, 1)[:, None])


def posteriors(fields, weights):
    """Posteriors of the tokens of several documents, in a row."""
    starts = np.cumsum([0, *[len(f.known) for f in fields]])
    unary = bits_of([m for f in fields for m in f.features]) @ weights["features"]
    chain = [(s + i, s + j) for s, f in zip(starts, fields) for i, j in f.chain]
    skip = [(s + i, s + j) for s, f in zip(starts, fields) for i, j in f.skip]
    first, last = np.ones(len(unary), bool), np.ones(len(unary), bool)
    for i, j in chain:
        last[i] = first[j] = False
    unary[first] += weights["chain"][OUTSIDE]
    unary[last] += weights["chain"][:, OUTSIDE]
    known = np.array([y for f in fields for y in f.known], int)
    sure = np.flatnonzero(known)
    unary[sure] = -1e4
    unary[sure, known[sure]] = 0.0
    potentials = np.concatenate([
        np.broadcast_to(weights["chain"], (len(chain), LABELS, LABELS)),
        np.broadcast_to(np.diag(weights["skip"]), (len(skip), LABELS, LABELS))])
    return np.split(marginals(unary, chain + skip, potentials), starts[1:-1])


def mentions(field, posterior):
    """(kind number, start, end) of runs of tokens that the field adds to the patterns' spans."""
    label = posterior.argmax(axis=1)
    label[posterior.max(axis=1) < CERTAIN] = OUTSIDE
    label[np.array(field.known, int) > 0] = OUTSIDE
    groups = field.skip_groups()
    follows = {j for _, j in field.chain}
    runs = []
    for i, y in enumerate(label.tolist()):
        if y and runs and i in follows and runs[-1][1] == i - 1 and label[i - 1] == y:
            runs[-1][1] = i
        elif y:
            runs.append([i, i, y])
    return [(y - 1, field.cores[i][0], field.cores[j][1]) for i, j, y in runs
            if any(y in groups[k] for k in range(i, j + 1))]


def find(docs, weights):
    """`doc_id` and `spans` (kind, start, end, base) of every row of `docs`, by kind, then start.

    Positions count code points, ends are exclusive. Spans of the patterns have `base`; those that the field
    adds are `email_mention` and so on, behind all of them, and overlap none. A null or
    empty text has no spans; repeated rows have a row each, a null id stays null, texts are taken
    whole, other columns are ignored.
    """
    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                some = pc.match_substring_regex(texts, "[0-9@]")
                fields = [Field(text) for text in texts.filter(some).to_pylist()]
                spans = [[] for _ in range(part.num_rows)]
                at = np.flatnonzero(some.to_numpy(zero_copy_only=False)).tolist()
                for row, field, posterior in zip(at, fields, posteriors(fields, weights)
                                                 if fields else []):
                    spans[row] = [
                        *[(KINDS[k], a, b, True) for k, a, b in field.base],
                        *[(KINDS[k] + MENTION, a, b, False)
                          for k, a, b in sorted(mentions(field, posterior))]]
                names = ["kind", "start", "end", "base"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([[dict(zip(names, s)) for s in own] for own in spans],
                                              SPANS)], ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(rows, SCHEMA)


def digest(found):
    """Counts of the patterns' spans by kind, their hash and all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("bigint")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))
