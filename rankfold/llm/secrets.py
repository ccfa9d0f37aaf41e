"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

Base spans come from three patterns. The random field tags every token of a text
(words, numbers and runs of key characters) as secret begin, inside or outside,
from the token's shape, the tokens and characters around it and a feature of the
whole text, and is decoded by Viterbi. Nothing but the learned weights decides:
no length, digit or pattern is asked for.

It is trained here, on labelled examples built by rule (contexts that name a
secret or don't, filled with secrets of several kinds, with ordinary strings and
with words; ``EXAMPLE_SEED``), on a few written ones (``EXAMPLES``), and on the base
spans, with the tokens around them, of a bounded sample of documents
(``TRAIN_DOCS``, smallest id hash, whole texts), beside one stretch of ordinary
tokens of every ``PLAIN_EVERY``-th of them. All stretches found are used.

The potentials of all tokens of a text are summed at once: what a word alone
shows is weighed once and remembered. Taking a token out of a secret changes the
score by its own potentials, by the transitions, and by its next token being a
begin instead of inside; where that is a gain whatever the labels around, the
token is outside on every best path. Viterbi runs over the stretches of other
tokens, with outside at both ends: the result is the best path of the whole text.

Spans are (kind, start, end) in code points, end exclusive. Base spans stay;
tokens inside one are held to be secret, and spans of kind ``crf`` are what the
field tags beside base spans. Null and empty texts have none. Texts are read
whole. Repeated rows give repeated rows; a null doc_id is passed through. Without
a base span in the sample the examples alone teach the field.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankfold.llm.common import forget, hand_back, map_batches, slices, text_rows, written

TRAIN_DOCS = 20_000
MARK = "<SECRET>"

# Fixed patterns of the contract.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")

_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_DIGITS = bytes(range(48, 58))
PLAIN_EVERY = 8
AROUND = 6  # tokens on each side of a labelled span

#: Tokens of a text: runs of letters, digits and the characters that keys are made of.
TOKEN = re.compile(r"[\w+/-]+")
_TOKENS = re.compile(f"({TOKEN.pattern})")
_CUES = frozenset("password passwd passphrase passcode pass pw pwd secret secrets token tokens apikey api_key key keys credential "
                  "credentials cred creds auth authorization bearer login pin private access access_key secret_key".split())
_CUE_END = re.compile(r"(?:^|[_-])(?:password|passwd|secret|token|key|pwd|credentials?)$")
_LEAD = re.compile(r"(?:AKIA|ASIA|gh[pousr]_|sk-|sk_|pk_|xox[abprs]-|eyJ|glpat-|AIza|MII)")
_STEP = re.compile(r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+")
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]+", re.I)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = []
    low = text.encode("utf-8", "surrogatepass").lower()
    if any(k in low for k in _KEYS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def bucket(n: int, *edges: int) -> int:
    """How many of the edges ``n`` reaches."""
    return sum(n >= e for e in edges)


def is_cue(token: str) -> bool:
    """Whether a token names a secret."""
    low = token.lower()
    return low in _CUES or bool(_CUE_END.search(low))


def pattern(s: str) -> int:
    """0 small letters, 1 a capitalised word, 2 capitals, 3 digits, 4 small words joined, 5 other joined letters, 6 letters and digits,
    7 letters of mixed case, 8 joined with digits."""
    joined = any(c in "+/_-" for c in s)
    digits, letters = any(map(str.isdigit, s)), any(map(str.isalpha, s))
    if joined:
        return 8 if digits else 4 if s.lower() == s else 5
    if digits:
        return 6 if letters else 3
    return 0 if s.lower() == s else 1 if s[1:].lower() == s[1:] else 2 if s.upper() == s else 7


def word_features(s: str) -> tuple[int, ...]:
    """What a token alone shows."""
    mixed = any(map(str.isupper, s)) + 2 * any(map(str.islower, s)) + 4 * any(map(str.isdigit, s)) + 8 * any(c in "+/_-" for c in s)
    return (bucket(len(s), 3, 5, 8, 12, 16, 20, 28, 40), mixed, bucket(len(_STEP.findall(s)), 2, 3, 5, 8, 13),
            pattern(s), int(len(s) >= 8 and all(c in "0123456789abcdefABCDEF" for c in s)),
            bucket(max(map(len, _CONSONANTS.findall(s)), default=0), 5, 8), int(bool(_LEAD.match(s))), int(is_cue(s)))


def gap(s: str) -> int:
    """What stands between two tokens: 0 an end of the text, 1 space, 2 an assignment, 3 a quote or bracket, 4 one joining mark, 5 else."""
    if not s or "\n" in s:
        return 0
    if s in (".", "="):
        return 4
    if ":" in s or "=" in s:
        return 2
    return 1 if s.isspace() else 3 if any(c in "\"'`<>()[]{}" for c in s) else 5


#: Values of each feature: a token's own (8); gap before and after, distance of the last cue, next token a cue, kind of the token
#: before; near a cue by pattern, after an assignment by pattern; digits in the text.
SIZES = (9, 16, 6, 9, 2, 3, 2, 2, 6, 6, 4, 2, 5, 18, 18, 3)
OWN = 8
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)[:-1]])
WIDTH = sum(SIZES) + 1  # and a constant
#: Features whose weight is the same for begin and inside: what they look like doesn't tell where a secret starts.
TIED = np.concatenate([np.full(n, k < OWN or k >= 13) for k, n in enumerate(SIZES)] + [[False]])


def digit_share(text: str) -> int:
    """A feature of the whole text: how much of it is digits."""
    raw = text.encode("utf-8", "surrogatepass")
    share = 1 - len(raw.translate(None, _DIGITS)) / max(1, len(raw))
    return 0 if share < 0.01 else 1 if share < 0.1 else 2


def features(text: str, spans: list[tuple[int, int]], at: int, share: int) -> tuple[int, ...]:
    """All features of the token ``spans[at]``."""
    a, b = spans[at]
    own = lambda i: word_features(text[slice(*spans[i])])
    mine = own(at)
    before = gap(text[spans[at - 1][1]: a]) if at else 0
    after = gap(text[b: spans[at + 1][0]]) if at + 1 < len(spans) else 0
    cue = next((d for d in (1, 2, 3) if at >= d and own(at - d)[7]), 0)
    last = own(at - 1)[3] if at else -1
    kind = 0 if last < 0 else 1 if last < 3 else 2 if last == 3 else 3 if last in (4, 5) else 4
    return (*mine, before, after, cue, int(at + 1 < len(spans) and own(at + 1)[7]), kind,
            mine[3] + 9 * (cue > 0), mine[3] + 9 * (before == 2), share)


O, B, I = 0, 1, 2  # noqa: E741


class Field:
    """Weights of features by label, and of label pairs; outside before and after every chain."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def outside(self, e: np.ndarray) -> np.ndarray:
        """Which tokens are outside on every best path, given the potentials of a text's tokens."""
        m, shift = self.move, np.zeros(len(e))
        shift[:-1] = e[1:, I] - e[1:, B]
        out = np.ones(len(e), bool)
        for x, before in ((B, (O, B, I)), (I, (B, I))):
            least = np.minimum(min(m[O, O] - m[x, O], m[O, B] - m[x, B]), m[O, B] - m[x, I] - shift)
            out &= e[:, O] - e[:, x] + min(m[p, O] - m[p, x] for p in before) + least > 0
        return out

    def potentials(self, tokens: list[tuple[int, ...]]) -> np.ndarray:
        return self.emit[np.array(tokens) + OFFSETS].sum(1) + self.emit[-1]

    def viterbi(self, tokens: list[tuple[int, ...]], held: list[bool] | None = None) -> list[int]:
        """The best path; ``held`` tokens are part of a secret."""
        return self.best_path(self.potentials(tokens), held)

    def best_path(self, e: np.ndarray, held=None) -> list[int]:
        if held is not None:
            e = e.copy()
            e[held, O] += FORBIDDEN
        best, back = self.move[O] + e[0], []
        for x in e[1:]:
            cand = best[:, None] + self.move
            back.append(cand.argmax(0))
            best = cand.max(0) + x
        label = int((best + self.move[:, O]).argmax())
        path = [label]
        for pointers in reversed(back):
            path.append(label := int(pointers[label]))
        return path[::-1]


FORBIDDEN = -1e4  # inside after outside


def train(chains: list[tuple[list[tuple[int, ...]], list[int], float]], steps: int = 200) -> Field | None:
    """Maximum likelihood by Adam; chains are (tokens, labels, count). None if no chain holds a secret."""
    if not any(any(y) for _, y, _ in chains):
        return None
    kinds = {t: i for i, t in enumerate(dict.fromkeys(t for tokens, _, _ in chains for t in tokens))}  # distinct tokens
    table = np.array(list(kinds)) + OFFSETS
    groups: dict[int, list] = {}
    for c in chains:
        groups.setdefault(len(c[0]), []).append(c)
    total = sum(w for *_, w in chains)
    data = [(n, np.array([[kinds[t] for t in x] for x, _, _ in cs]), np.array([y for _, y, _ in cs]), np.array([w for *_, w in cs], float) / total)
            for n, cs in sorted(groups.items())]
    emit, move = np.zeros((WIDTH, 3)), np.zeros((3, 3))
    legal = np.ones((3, 3), bool)
    legal[O, I] = False
    m, v = [np.zeros_like(emit), np.zeros_like(move)], [np.zeros_like(emit), np.zeros_like(move)]

    def lse(z, axis):
        top = z.max(axis)
        return top + np.log(np.exp(z - np.expand_dims(top, axis)).sum(axis))

    for step in range(1, steps + 1):
        ge, gm = 2e-4 * emit, 2e-4 * move
        mv = np.where(legal, move, FORBIDDEN)
        score = emit[table].sum(1) + emit[-1]
        gk = np.zeros_like(score)
        for length, x, y, w in data:
            e = score[x]
            f = [mv[O] + e[:, 0]]
            for t in range(1, length):
                f.append(lse(f[-1][:, :, None] + mv, 1) + e[:, t])
            b = [np.broadcast_to(mv[:, O], f[0].shape)]
            for t in range(length - 1, 0, -1):
                b.insert(0, lse(mv[None] + (e[:, t] + b[0])[:, None, :], 2))
            z = lse(f[-1] + mv[:, O], 1)
            p = np.exp(np.stack(f, 1) + np.stack(b, 1) - z[:, None, None])
            np.put_along_axis(p, y[:, :, None], np.take_along_axis(p, y[:, :, None], 2) - 1, 2)
            p *= w[:, None, None]
            for k in range(3):
                gk[:, k] += np.bincount(x.ravel(), p[:, :, k].ravel(), len(score))
            for t in range(1, length):
                q = np.exp(f[t - 1][:, :, None] + mv + (e[:, t] + b[t])[:, None, :] - z[:, None, None]) * w[:, None, None]
                gm += q.sum(0) - np.bincount(3 * y[:, t - 1] + y[:, t], w, 9).reshape(3, 3)
            # from and to the outside at the ends
            gm[O] += (np.exp(f[0] + b[0] - z[:, None]) * w[:, None]).sum(0) - np.bincount(y[:, 0], w, 3)
            gm[:, O] += (np.exp(f[-1] + mv[:, O] - z[:, None]) * w[:, None]).sum(0) - np.bincount(y[:, -1], w, 3)
        for k in range(3):
            ge[:-1, k] += np.bincount(table.ravel(), np.repeat(gk[:, k], table.shape[1]), WIDTH - 1)
        ge[-1] += gk.sum(0)
        ge[TIED, B] = ge[TIED, I] = (ge[TIED, B] + ge[TIED, I]) / 2
        for i, (param, g) in enumerate(((emit, ge), (move, np.where(legal, gm, 0)))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            param -= 0.1 * m[i] / (1 - 0.9 ** step) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Field(emit, np.where(legal, move, FORBIDDEN))


#: Written examples: what stands between the double braces is a secret.
EXAMPLES = (
    "export KEY={{9f8Qz71LmKp02sXw44Tb}}", "Authorization: Bearer {{eyJhbGciOi1JIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dBjftJeZ4CVPmB92K27u}}",
    "use {{ghp_16C7e42F292c6912E7710c838347Ae178B4a}} to log in", "private key: {{MIIEvQIBADANBgkqhkiG9w0BAQEFAASC}}",
    "credentials {{7Hq2Vd9xKe41RtYu83Wp}}", "secret_access {{wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY0}}", "auth = '{{sk-4fKd82Lw0Zx7Qp93Vm1Nc6Tb}}'",
    "the key is {{E03422DAD6B454724135A384F69BA12C}}", "é {{wJalrXUtnFEMIK7MDENGbPxRfiCY}} z", "{{Zx81kQpLmN20vBt7.Kw9sDf3GhJ5}}", "{{pT5xLq92WmZk81Rv=Hn4Yc6Bd}} z",
    "see report-2021-final-version2 for more", "from 2021-05-06T10-30-00Z on", "file IMG_20210506_123456 was lost", "covid-19-related costs",
    "version v1-2-3-beta-release", "at /home/user/photos/summer2019/beach", "isbn ISBN978-3-16-148410-0 is out", "meeting room-b12-floor3-west",
    "chapter12-section4-part2", "call +1-659-555-3949x22 now", "www/example/page2/article15", "order no A-2021-00012345", "user_name_1985_berlin wrote",
    "hotel2stars-3nights-4people", "GB29NWBK60161331926819 is the account", "the 100-year-old-house", "iso8859-1-encoding", "model T5-large-v1_1",
    "api_key:short", "password: yes", "token: none", "a clean text from 2021-05-06", "the password was changed yesterday", "please reset your password soon",
    "token ring networks were slow", "the secret of success is patience", "key findings: revenue grew by 12 percent", "access to the building is limited",
    "login to the portal first", "the private sector paid for it", "keys and tokens, please.", "a secret-sharing scheme", "MacDonald and McKinsey met iPhone users",
    "write to jane.doe2@example.org or visit https://www.example.org/a/b?id=17", "two words", "state-of-the-art methods", "mother-in-law of the ex-president",
)
EXAMPLE_SEED, EXAMPLE_ROUNDS = 4, 3
_WORDS = ("apple river stone window market yellow garden paper winter candle forest bridge silver planet copper orange castle ticket engine shadow "
          "pencil summer pocket rocket lemon monkey tiger battery staple horse correct dragon monday coffee").split()
#: Contexts that name a secret, and ordinary ones; {} is filled in.
_NAMING = ("password is {} now", "pw {}", "pw is {} here", "my pass: {}", "credentials: {}", "the login pin is {}, thanks", "api key {} for the test", "key = \"{}\"",
           "use token {} until friday", "auth: {}", "aws_secret {}", "access_key={}", "passphrase '{}'", "bearer {}", "private key {} follows", "secret -> {}")
_ORDINARY = ("we met {} at the station", "a {} of the house", "{}", "see {} for more", "the {} was, in short, {}", "order {}, page {}", "from {} to {}", "it is {} here.")


def _secret(rng: random.Random) -> str:
    letters, digits = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    kind = rng.randrange(7)
    if kind == 0:
        return some(letters, rng.randrange(16, 44))
    if kind == 1:
        return some(letters + digits, rng.randrange(10, 44))
    if kind == 2:
        return "-".join(rng.sample(_WORDS, rng.randrange(3, 5)))
    if kind == 3:  # a word with letters swapped for digits
        swap = str.maketrans("aeiost", "431057")
        word = rng.choice(_WORDS).capitalize() + rng.choice(_WORDS)
        return word[:2] + word[2:].translate(swap) + some(digits, rng.randrange(0, 3))
    if kind == 4:
        return some("0123456789ABCDEF", rng.randrange(16, 41))
    if kind == 5:
        return some(letters + digits + "+/", rng.randrange(20, 60))
    return f"{some(letters, 3).lower()}_{some(letters + digits, rng.randrange(16, 30))}"


def _plain(rng: random.Random) -> str:
    kind = rng.randrange(8)
    if kind < 4:
        return rng.choice(_WORDS) if kind else rng.choice(_WORDS).capitalize()
    if kind == 4:
        return str(rng.randrange(1, 10 ** rng.randrange(1, 7)))
    if kind == 5:
        return f"{rng.randrange(1900, 2040)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"
    if kind == 6:
        return "-".join(rng.sample(_WORDS, 2))
    return rng.choice(("NATO", "covid-19", "iPhone12", "page_2", "A4", "v2", "UTF-8", "2nd", "x86_64", "file3", "B12", "ISO-9001", "E-mail", "http", "R2"))


def examples() -> list[str]:
    """All labelled examples: the written ones, and contexts filled by rule."""
    rng, out = random.Random(EXAMPLE_SEED), list(EXAMPLES)
    filled = lambda context, make: re.sub(r"\{\}", lambda _: make(), context)
    for _ in range(EXAMPLE_ROUNDS):
        for context in _NAMING:
            out += [filled(context, lambda: "{{" + _secret(rng) + "}}") for _ in range(3)]
            out += [filled(context, lambda: rng.choice(_WORDS)), filled(context, lambda: _plain(rng))]
        for context in _ORDINARY:
            out += [filled(context, lambda: _plain(rng)) for _ in range(4)]
            out.append(" ".join(rng.choice(_WORDS) for _ in range(8)))
    return out


def labelled(text: str, spans: list[tuple[int, int]], secret: list[tuple[int, int]], share: int | None = None) -> tuple[list, list]:
    """(features, labels) of a text's tokens; tokens that overlap a secret are begin, or inside the same one."""
    share = digit_share(text) if share is None else share
    labels, now = [], None
    for a, b in spans:
        hit = next((k for k, (s, e) in enumerate(secret) if s < b and a < e), None)
        labels.append(O if hit is None else I if hit == now else B)
        now = hit
    return [features(text, spans, i, share) for i in range(len(spans))], labels


def example_chains() -> list[tuple[list[tuple[int, ...]], list[int], float]]:
    out = []
    for marked in examples():
        text, secret, at = "", [], 0
        for m in re.finditer(r"\{\{(.*?)\}\}", marked):
            text += marked[at: m.start()]
            secret.append((len(text), len(text) + len(m[1])))
            text, at = text + m[1], m.end()
        text += marked[at:]
        x, y = labelled(text, [t.span() for t in TOKEN.finditer(text)], secret, 0)
        out.append((x, y, 5.0))
    return out


def stretches(key, text: str) -> list[tuple[list, list]]:
    """Labelled stretches of a document: around its base spans, or, of some documents without any, one of ordinary tokens."""
    spans, base = [t.span() for t in TOKEN.finditer(text)], [(s, e) for s, _, e in base_spans(text)]
    if not spans:
        return []
    share, out = digit_share(text), []
    if base:
        hit = [i for i, (a, b) in enumerate(spans) if any(s < b and a < e for s, e in base)]
        cuts = [k for k in range(1, len(hit)) if hit[k] - hit[k - 1] > 2 * AROUND]
        for lo, hi in zip([0, *cuts], [*cuts, len(hit)]):
            out.append((max(0, hit[lo] - AROUND), min(len(spans), hit[hi - 1] + AROUND + 1)))
    else:
        h = int(hashlib.md5(repr(key).encode()).hexdigest()[:12], 16)
        if h % PLAIN_EVERY:
            return []
        start = h // PLAIN_EVERY % len(spans)
        out.append((start, min(len(spans), start + 2 * AROUND)))
    got = []
    for lo, hi in out:
        x, y = labelled(text, spans[max(0, lo - 3): hi + 1], base, share)  # with what the first and last features look at
        skip = lo - max(0, lo - 3)
        got.append((x[skip: skip + hi - lo], y[skip: skip + hi - lo]))
    return got


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """The field, trained on the examples and on the sampled documents."""
    x = text_rows(docs, id_col, text_col)
    ids = x.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(train_docs)
    x = x.join(F.broadcast(written(ids, "secrets-sample")), F.col(id_col) == F.col("id"), "left_semi")

    def run(_, cols):
        got = [c for k, t in zip(cols[id_col], cols[text_col]) if t for c in stretches(k, t)]
        return {"x": [[v for t in tokens for v in t] for tokens, _ in got], "y": [y for _, y in got]}

    rows = map_batches(x, run, "x array<int>, y array<int>").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((tuple(r["x"]), tuple(r["y"]), r["n"]) for r in rows.collect())  # of at most ``train_docs`` documents
    k = len(SIZES)
    # each example counts as some, and the sample's stretches together as much as all examples
    given = example_chains()
    weight = sum(w for *_, w in given) / max(1, sum(n for *_, n in rows))
    return train([([x[i: i + k] for i in range(0, len(x), k)], list(y), n * min(1.0, weight)) for x, y, n in rows] + given)


def uncovered(start: int, end: int, base: list[tuple[int, int, int]], text: str):
    """The parts of a span outside the base spans, without joining marks at their ends."""
    for s, _, e in [*base, (end, 0, end)]:
        if s > start:
            a, b = start, min(s, end)
            while a < b and text[a] in ".=":
                a += 1
            while b > a and text[b - 1] in ".=":
                b -= 1
            if a < b:
                yield a, b
        start = max(start, e)
        if start >= end:
            break


class Tagger:
    """A field, with what it has worked out of words met before in this process."""

    MEMO = 200_000  # words remembered; beyond it the memory starts anew

    def __init__(self, field: Field):
        self.field, self.parts = field, np.split(field.emit[:-1], OFFSETS[1:])
        self.start()
        tagger = self

        class Gaps(dict):
            def __missing__(self, s):
                if len(self) > tagger.MEMO:
                    self.clear()
                self[s] = g = gap(s)
                return g

        self.gaps = Gaps()

    def start(self) -> None:
        """Words are numbered by what they show; a row of potentials, a pattern and a cue mark for each kind."""
        self.kinds: dict[tuple, int] = {}
        self.own, self.pattern, self.cue = np.zeros((0, 3)), np.zeros(0, np.int64), np.zeros(0, bool)
        tagger = self

        class Words(dict):
            def __missing__(self, word):
                own = word_features(word)
                kind = tagger.kinds.setdefault(own, len(tagger.kinds))
                self[word] = kind
                return kind

        self.words = Words()

    def potentials(self, words: list[str], gaps: list[str], share: int) -> np.ndarray:
        """The potentials of all tokens of a text; ``gaps`` stand between them."""
        if len(self.words) > self.MEMO:
            self.start()
        kind = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        if len(self.own) < len(self.kinds):
            new = np.array(list(self.kinds))
            self.own, self.pattern, self.cue = self.field.emit[new + OFFSETS[:OWN]].sum(1), new[:, 3], new[:, 7] > 0
        n, p, cue = len(words), self.pattern[kind], self.cue[kind]
        between = np.fromiter(map(self.gaps.__getitem__, gaps), np.int64, n - 1)
        before, after = np.concatenate([[0], between]), np.concatenate([between, [0]])
        dist = np.zeros(n, np.int64)
        for d in (3, 2, 1):
            dist[d:][cue[:-d]] = d
        follows = np.zeros(n, np.int64)
        follows[:-1] = cue[1:]
        last = np.zeros(n, np.int64)
        last[1:] = np.array([1, 1, 1, 2, 3, 3, 4, 4, 4])[p[:-1]]
        w = self.parts
        return (self.own[kind] + w[8][before] + w[9][after] + w[10][dist] + w[11][follows] + w[12][last] + w[13][p + 9 * (dist > 0)]
                + w[14][p + 9 * (before == 2)] + (w[15][share] + self.field.emit[-1]))

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The spans the field adds to the base spans."""
        pieces = _TOKENS.split(text)
        words = pieces[1::2]
        if not words:
            return []
        e = self.potentials(words, pieces[2:-1:2], digit_share(text))
        look = ~self.field.outside(e)
        if not look.any():
            return []
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))[1::2]
        starts = ends - np.fromiter(map(len, words), np.int64, len(words))
        held = np.zeros(len(words), bool)
        for s, _, end in base:
            held[np.searchsorted(starts, s, "left"): np.searchsorted(ends, end, "right")] = True
        look |= held
        edge = np.flatnonzero(np.diff(np.concatenate([[0], look.view(np.int8), [0]])))
        out = []
        for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if held[lo:hi].all():
                continue
            path, start = self.field.best_path(e[lo:hi], held[lo:hi]), None
            for i, label in [*zip(range(lo, hi), path), (hi, O)]:
                if label != I and start is not None:
                    out += [(a, 3, b) for a, b in uncovered(start, int(ends[i - 1]), base, text)]
                    start = None
                if label == B:
                    start = int(starts[i])
        return out


_TAGGERS: dict[int, Tagger] = {}


def all_spans(text: str | None, field: Field | None) -> list[tuple[int, int, int]]:
    """(start, kind, end): base spans and those the field adds."""
    if not text:
        return []
    base = base_spans(text)
    if field is None:
        return base
    tagger = _TAGGERS.get(id(field))
    if tagger is None or tagger.field is not field:
        _TAGGERS.clear()
        _TAGGERS[id(field)] = tagger = Tagger(field)
    return sorted(base + tagger.spans(text, base))


def written_out(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def op7(docs: DataFrame) -> DataFrame:
    field = fit(docs)
    ids = docs.select("doc_id").schema[0].dataType.simpleString()

    def run(_, cols):
        found = [all_spans(t, field) for t in cols["text"]]
        count = lambda k: [sum(x[1] == k for x in f) for f in found]
        sha = [hashlib.sha256(written_out([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found]
        return {"doc_id": cols["doc_id"], "n_assign": count(0), "n_access": count(1), "n_hex": count(2), "base_sha256": sha,
                "spans": [written_out(f) for f in found], "n_crf": count(3)}

    return map_batches(text_rows(docs, "doc_id", "text"), run, f"doc_id {ids}, n_assign long, n_access long, n_hex long, "
                       "base_sha256 string, spans string, n_crf long")


def redacted(text: str | None, field: Field | None) -> str | None:
    """The text with every secret (overlapping spans as one) replaced by MARK."""
    spans = all_spans(text, field)
    if not spans:
        return text
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], MARK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced; n_chars (if there) follows the text. All columns are kept."""
    field = fit(docs)

    place = docs.columns.index("text")

    def run(batches):
        forget()
        for batch in (part for whole in batches for part in slices(whole)):
            text = batch.column(place)
            clean = pa.array((redacted(t.as_py(), field) for t in text), text.type, size=len(text))
            yield batch.set_column(place, batch.schema.field(place), clean)
        hand_back()

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
