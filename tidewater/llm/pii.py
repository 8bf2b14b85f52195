"""Personal data: exact patterns, and a linear-chain CRF over word shapes for what they miss."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import bound_batches

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that the CRF adds.
CRF_KINDS = ("secret", "email_spelled", "phone_local", "id_number")
KINDS = BASE_KINDS + CRF_KINDS
TAGS = ["O", *(f"{p}-{k}" for k in CRF_KINDS for p in "BI")]
#: Distinct words, and distinct neighbourhoods of words, that a worker remembers.
MEMO = 60_000
#: Words decoded at a time; bounds a worker's memory.
WORDS_AT_ONCE = 100_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What every base pattern holds.
_ANY = re.compile(r"[0-9@]")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their '@' in linear time."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of the exact patterns; matches that fail their check are dropped, not retried."""
    out: dict = {k: [] for k in BASE_KINDS}
    out["email"] = emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


# --- the CRF -----------------------------------------------------------------

_TOKEN = re.compile(r"\S+")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&"
#: Words that announce a kind.
_CUES = {
    "secret": "token key apikey api_key secret password passwd pwd bearer access_key secret_key auth_token credential aws_secret_access_key",
    "mail": "email mail e-mail contact write",
    "phone": "phone tel telephone call mobile cell fax telefon tel. teléfono téléphone",
    "id": "ssn passport iban id no number nr account tax social security ausweis dni nif",
    "at": "at (at) [at] arroba",
    "dot": "dot (dot) [dot] punto punkt point",
    "sign": "= := : is -",
}
_CUE_OF = {w: c for c, words in _CUES.items() for w in words.split()}
#: Letters by their category, but neither capital nor small in _SHAPES.
_LETTER_SIGNS = frozenset("ªºµ")
_SHAPES = [(re.compile("[A-ZÀ-ÖØ-Þ]+"), "X"), (re.compile("[a-zß-öø-ÿ]+"), "x"), (re.compile("[0-9]+"), "9")]


def _shape(core: str) -> str:
    """Runs of capitals, letters and digits as one sign each; of long shapes both ends."""
    for pattern, to in _SHAPES:
        core = pattern.sub(to, core)
    return core if len(core) <= 12 else core[:6] + "~" + core[-6:]


def _about(word: str) -> tuple[str, ...]:
    """What a word says of itself: shape, cue, size, digits, how mixed; all of it is read."""
    core = word.strip(".,")
    if core.isalpha() and (core.isascii() or (max(core) <= "ÿ" and _LETTER_SIGNS.isdisjoint(core))):
        form = "x" if core.islower() else "X" if core.isupper() else "Xx" if core[1:].islower() and core[0].isupper() else ""
        if form:  # most words; what follows says the same of them
            size = str(min(9, len(core) // 4))
            return (form, _CUE_OF.get(core.lower(), "-"), size, "0", "plain" + size)
    core = word.strip(_EDGE)
    low = word.lower().strip("\"'`,;!?.:") or word
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    changes = sum(a.isdigit() != b.isdigit() for a, b in itertools.pairwise(core))
    size = "0" if not core else str(min(9, len(core) // 4))
    mixed = "mixed" if digits >= 4 and letters >= 4 and changes >= 6 else "plain"
    return (_shape(core), _CUE_OF.get(low, "-"), size, str(min(digits, 12)), mixed + size)


#: What stands for a neighbour that isn't there.
_NONE = ("^", "^", "", "", "")


def _features(before: tuple, p: tuple, x: tuple, n: tuple) -> list[str]:
    """Of a word, by what it, the two words before it and the next one say."""
    return ["bias", "s=" + x[0], "c=" + x[1], "n=" + x[2], "d=" + x[3], "m=" + x[4], "p=" + p[0], "pc=" + p[1],
            "q=" + n[0], "qc=" + n[1], "ppc=" + before[1], "sp=" + x[0] + "/" + p[0], "sq=" + x[0] + "/" + n[0],
            "cc=" + p[1] + "/" + before[1], "dc=" + x[3] + "/" + p[1]]


def features(words: list[str]) -> list[list[str]]:
    a = [_NONE, _NONE, *map(_about, words), _NONE]
    return [_features(*a[i : i + 4]) for i in range(len(words))]


def training_table(seed: int = 7, n: int = 600) -> list[tuple[list[str], list[str]]]:
    """The labelled table: short invented sentences, (words, tags), made from templates."""
    r = random.Random(seed)
    vowel, rest = "aeiou", "bcdfghklmnprst"

    def word():
        if r.random() < 0.12:  # words that announce something elsewhere
            return r.choice(["at", "at", "at", "to", "is", "no", "point", "a", "in", "is,", "at,"])
        return "".join(r.choice(rest) + r.choice(vowel) for _ in range(r.randint(1, 4))) + r.choice(["", "", "n", "s", ".", ","])

    def name():
        return "".join(r.choice(rest) + r.choice(vowel) for _ in range(r.randint(1, 4))) + r.choice(["", "n", "s"])

    def digits(k):
        return "".join(r.choice("0123456789") for _ in range(k))

    def hexes(k):
        return "".join(r.choice("0123456789abcdef") for _ in range(k))

    def secret():
        body = r.choice([hexes(r.randint(24, 48)), hexes(r.randint(24, 40)).upper(), "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(r.randint(20, 44)))])
        if r.random() < 0.25:  # letters alone
            body = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(18, 40)))
        cue = r.choice("api_key token secret_key password access_key auth_token TOKEN API_KEY SECRET".split())
        quote = r.choice(['"', "'", ""])
        return [(cue, "O"), *[(s, "O") for s in r.choice([["="], [":"], ["="], []])], (quote + body + quote + r.choice(["", ";", ",", "!!"]), "secret")]

    def spelled():
        at, dot = r.choice([("at", "dot"), ("(at)", "(dot)"), ("[at]", "[dot]"), (r.choice(["(at)", "[at]", "arroba", "at"]), r.choice(["dot", "(dot)", "[dot]", "punto", "punkt", "point"]))])
        words = [name(), at, name(), dot, r.choice(["com", "org", "net", "example"])]
        lead = [r.choice(["mail", "email", "contact", "write"]), *r.choice([[], [], ["to"], ["me", "to"], [word()]])]
        return [*[(w, "O") for w in lead], *[(w, "email_spelled") for w in words]]

    def local():
        p = r.choice([["(0%s)" % digits(2), digits(3), digits(4)], ["%s-%s-%s" % (digits(3), digits(3), digits(4))], ["(%s)" % digits(3), "%s-%s" % (digits(3), digits(4))], ["0" + digits(3), digits(6)]])
        return [(r.choice(["phone", "tel", "call", "mobile", "Telefon", "tel:"]), "O"), *[(w, "phone_local") for w in p]]

    def identity():
        p = r.choice([["%s-%s-%s" % (digits(3), digits(2), digits(4))], ["DE" + digits(2), digits(4), digits(4), digits(4), digits(4), digits(2)], [r.choice("ABCXK") + digits(8)]])
        cue = r.choice([["ssn"], ["passport"], ["iban"], ["SSN:"], ["passport", "no"], ["tax", "id"]])
        return [*[(c, "O") for c in cue], *[(w, "id_number") for w in p]]

    def number():  # numbers that are nobody's
        p = r.choice([["version", "2.0."], [digits(4)], ["in", "19" + digits(2)], [digits(1)], [digits(16)], ["+1", "(%s)" % digits(3), digits(3) + "-" + digits(4)], [".".join(digits(3) for _ in range(4))], [word().strip(".,") + digits(2) + "@mail" + digits(1) + ".example.com"], ["CC", "BY-NC", "4.0."], ["at", word()], ["dot", word()], ["the", "key", "is", word()], [digits(3) + "%"], ["page", digits(2)], ["%s-%s-%s" % ("20" + digits(2), digits(2), digits(2))], ["call", word()], ["sha", hexes(7)], ["id", digits(3)], ["number", digits(4)], [hexes(32)], ["no", digits(2)], ["point", word()], [word(), "punto", word()], ["".join(word().strip(".,") for _ in range(6))]])
        return [(w, "O") for w in p]

    table = []
    for _ in range(n):
        words, tags = [], []
        for part in r.choices([secret, spelled, local, identity, number], [3, 2, 2, 2, 6], k=r.randint(0, 2)):
            for _ in range(r.randint(1, 5)):
                words.append(word().capitalize() if r.random() < 0.1 else word())
                tags.append("O")
            past = "O"
            for w, k in part():
                words.append(w)
                tags.append("O" if k == "O" else ("I-" if past == k else "B-") + k)
                past = k
        for _ in range(r.randint(1, 4)):
            words.append(word())
            tags.append("O")
        table.append((words, tags))
    return table


@dataclass
class Crf:
    ids: dict[str, int]
    emit: np.ndarray  # (features, tags); row 0 is for unknown features
    move: np.ndarray  # (tags, tags)

    def scores(self, words: list[str]) -> np.ndarray:
        get = self.ids.get
        table = np.array([[get(f, 0) for f in fs] for fs in features(words)], np.int32)
        return self.emit[table].sum(axis=1)


def _allowed() -> np.ndarray:
    """0 for moves that may be, a large negative number for I- after another kind."""
    m = np.zeros((len(TAGS), len(TAGS)))
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            for i, s in enumerate(TAGS):
                if s == "O" or s[2:] != t[2:]:
                    m[i, j] = -1e4
    return m


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[str], list[str]]], rounds: int = 80, ridge: float = 0.02) -> Crf:
    """Maximum likelihood by batched forward-backward and Adam steps."""
    feats = [features(w) for w, _ in table]
    ids = {f: i + 1 for i, f in enumerate(sorted({f for s in feats for x in s for f in x}))}
    width, tags, n = max(map(len, feats)), len(TAGS), len(table)
    per = len(feats[0][0])
    x = np.zeros((n, width, per), np.int32)
    y = np.zeros((n, width), np.int32)
    live = np.zeros((n, width), bool)
    for i, (s, (_, t)) in enumerate(zip(feats, table, strict=True)):
        x[i, : len(s)] = [[ids[f] for f in fs] for fs in s]
        y[i, : len(s)] = [TAGS.index(v) for v in t]
        live[i, : len(s)] = True
    hot = np.eye(tags)[y] * live[..., None]
    both = live[:, 1:] & live[:, :-1]
    seen_moves = np.einsum("nta,ntb->ab", hot[:, :-1] * both[..., None], hot[:, 1:] * both[..., None])
    emit, move, ban = np.zeros((len(ids) + 1, tags)), np.zeros((tags, tags)), _allowed()
    state = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (emit, move)]
    flat = x.ravel()
    for step in range(1, rounds + 1):
        e = emit[x].sum(axis=2)
        m = move + ban
        ahead, back = np.zeros((n, width, tags)), np.zeros((n, width, tags))
        ahead[:, 0] = e[:, 0]
        for t in range(1, width):
            a = _logsum(ahead[:, t - 1, :, None] + m, 1) + e[:, t]
            ahead[:, t] = np.where(live[:, t, None], a, ahead[:, t - 1])
        for t in range(width - 2, -1, -1):
            b = _logsum(m + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where(live[:, t + 1, None], b, 0)
        total = _logsum(ahead[:, -1], 1)
        node = np.exp(ahead + back - total[:, None, None]) * live[..., None]
        pair = np.exp(
            ahead[:, :-1, :, None] + m + (e[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        grads = [np.zeros_like(emit), (pair * both[..., None, None]).sum(axis=(0, 1)) - seen_moves]
        diff = (node - hot).reshape(-1, tags)
        for t in range(tags):
            grads[0][:, t] = np.bincount(flat, np.repeat(diff[:, t], per), len(emit))
        for (p, g1, g2), g in zip(state, grads, strict=True):
            g = g / n + ridge * p / n * 10
            g1 *= 0.9
            g1 += 0.1 * g
            g2 *= 0.99
            g2 += 0.01 * g * g
            p -= 0.15 * (g1 / (1 - 0.9**step)) / (np.sqrt(g2 / (1 - 0.99**step)) + 1e-6)
    emit[0] = 0
    return Crf(ids, emit.astype(np.float32), (move + ban).astype(np.float32))


def viterbi(scores: list[np.ndarray], move: np.ndarray) -> list[np.ndarray]:
    """Best tags of many segments at once; segments of a like length share a padded batch."""
    out: list = [None] * len(scores)
    order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
    at = 0
    while at < len(order):
        width = len(scores[order[at]])
        width = max(8, 1 << (width - 1).bit_length())
        own = []
        while at < len(order) and len(scores[order[at]]) <= width and (not own or (len(own) + 1) * width <= 4 * WORDS_AT_ONCE):
            own.append(order[at])
            at += 1
        e = np.zeros((len(own), width, move.shape[0]), np.float32)
        lengths = np.array([len(scores[i]) for i in own])
        for k, i in enumerate(own):
            e[k, : lengths[k]] = scores[i]
        best, link = e[:, 0].copy(), np.zeros(e.shape, np.int8)
        best[:, [t[0] == "I" for t in TAGS]] -= 1e4
        rows = np.arange(len(own))
        for t in range(1, width):
            go = best[:, :, None] + move
            link[:, t] = go.argmax(axis=1)
            new = go.max(axis=1) + e[:, t]
            live = (t < lengths)[:, None]
            link[:, t] = np.where(live, link[:, t], np.arange(move.shape[0]))
            best = np.where(live, new, best)
        tag = best.argmax(axis=1)
        path = np.zeros((len(own), width), np.int8)
        for t in range(width - 1, -1, -1):
            path[:, t] = tag
            tag = link[rows, t, tag] if t else tag
        for k, i in enumerate(own):
            out[i] = path[k, : lengths[k]]
    return out


class Decoder:
    """Scores all words of texts; neighbourhoods of four words that say the same share a row of scores."""

    def __init__(self, crf: Crf):
        self.crf = crf
        m = crf.move.astype(np.float64)
        #: For each kind its two tags and the most that a move into a run of them, out of it and
        #: within it brings over having O there.
        self.bounds = []
        for begin in range(1, len(TAGS), 2):
            own, other = [begin, begin + 1], [k for k in range(len(TAGS)) if k not in (begin, begin + 1)]
            free = [k for k in other if TAGS[k][0] != "I"]
            into = (m[other, begin] - m[other, 0]).max()
            out = (m[np.ix_(own, free)] - m[0, free]).max()
            self.bounds.append((own, into, out, m[np.ix_(own, own)].max() - m[0, 0]))
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {_NONE: 0}
        self.said: list[tuple] = [_NONE]
        self.rows: dict[int, int] = {}
        self.table = np.zeros((1024, len(TAGS)), np.float32)

    def _kind(self, word: str) -> int:
        about = _about(word)
        found = self.kinds.get(about)
        if found is None:
            found = self.kinds[about] = len(self.said)
            self.said.append(about)
        if len(word) < 100:
            self.words[word] = found
        return found

    def _row(self, code: int) -> int:
        four = [self.said[code >> shift & 0xFFFF] for shift in (48, 32, 16, 0)]
        get, at = self.crf.ids.get, len(self.rows)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.crf.emit[[get(f, 0) for f in _features(*four)]].sum(axis=0)
        self.rows[code] = at
        return at

    def scores(self, words: list[str]) -> np.ndarray:
        """(words, tags), as ``Crf.scores`` has them."""
        if len(self.words) > MEMO or len(self.rows) > MEMO or len(self.said) > 30_000:
            self.forget()
        get = self.words.get
        k = np.zeros(len(words) + 3, np.uint64)
        kinds = [get(w) for w in words]
        k[2:-1] = [self._kind(w) if x is None else x for w, x in zip(words, kinds, strict=True)] if None in kinds else kinds
        if len(self.said) > 65_535:  # one text with more kinds of words than a code can name
            self.forget()
            return self.crf.scores(words)
        codes = (k[:-3] << np.uint64(48)) | (k[1:-2] << np.uint64(32)) | (k[2:-1] << np.uint64(16)) | k[3:]
        own, back = np.unique(codes, return_inverse=True)
        rows = [self.rows[c] if c in self.rows else self._row(c) for c in own.tolist()]
        return self.table[np.array(rows, np.int64)[back]]

    def stretches(self, e: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of all stretches of words that a best path may tag; it has O everywhere else.

        A run of one kind's tags is only as good as O in its place if its words' gains, with
        the most that its moves can bring, sum up to zero or more. Runs at an end of the text
        lack a move. A word is in such a run if and only if a prefix sum from it on reaches
        one before it.
        """
        may = np.zeros(len(e) + 2, bool)
        for own, into, out, within in self.bounds:
            gains = (e[:, own].max(axis=1) - e[:, 0]).astype(np.float64) + within
            sums = np.concatenate([[0.0], np.cumsum(gains)])
            starts, ends = sums[:-1] - into, sums[1:] + out - within
            starts[0] -= max(0.0, -into)
            ends[-1] += max(0.0, -out)
            low, high = np.minimum.accumulate(starts), np.maximum.accumulate(ends[::-1])[::-1]
            may[1:-1] |= high - low >= -1e-3
        turns = np.flatnonzero(may[1:] != may[:-1])
        return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def segments(words: list[str], decoder: Decoder) -> list[tuple[int, np.ndarray]]:
    """(first word, scores) of what has to be decoded: each stretch between two words that are held at O."""
    if not words:
        return []
    e, out = decoder.scores(words), []
    for a, b in decoder.stretches(e):
        first, last = max(0, a - 1), min(len(words), b + 1)
        own = e[first:last].copy()
        if first < a:
            own[0, 1:] = -1e4
        if last > b:
            own[-1, 1:] = -1e4
        out.append((first, own))
    return out


def crf_spans(texts: list[str], decoder: Decoder) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) that the CRF finds in each text, all words decoded, trimmed of outer punctuation."""
    out: list = [[] for _ in texts]
    held, size = [], 0

    def flush():
        nonlocal held, size
        tags = viterbi([s for _, _, s in held], decoder.crf.move)
        for (i, spans, _), path in zip(held, tags, strict=True):
            if not path.any():
                continue
            text, open_ = texts[i], None
            for (a, b), t in [*zip(spans, path, strict=True), ((0, 0), 0)]:
                tag = TAGS[t]
                if tag[0] == "I" and open_:
                    open_[2] = b
                    continue
                if open_:
                    kind, s, e = open_
                    while s < e and text[s] in _EDGE + "=":
                        s += 1
                    while e > s and text[e - 1] in _EDGE:
                        e -= 1
                    if s < e:
                        out[i].append((kind, s, e))
                open_ = [tag[2:], a, b] if tag[0] == "B" else None
        held, size = [], 0

    for i, text in enumerate(texts):
        words = text.split()
        own = segments(words, decoder)
        if own:
            spans = [m.span() for m in _TOKEN.finditer(text)]
            for first, e in own:
                held.append((i, spans[first : first + len(e)], e))
                size += len(e)
            if size > WORDS_AT_ONCE:
                flush()
    if held:
        flush()
    return out


def find(text: str | None, extra: list[tuple[str, int, int]]) -> tuple:
    """Counts, digest and spans of one text; CRF spans that touch a base span are left out."""
    text = text or ""
    base = base_spans(text) if _ANY.search(text) else {k: [] for k in BASE_KINDS}
    taken = sorted(s for v in base.values() for s in v)
    listed = [f"{k}:{a}:{b}" for k in BASE_KINDS for a, b in base[k]]
    free = [x for x in extra if not any(a < x[2] and x[1] < b for a, b in taken)] if len(taken) < 64 else _free(extra, taken)
    more = [f"{k}:{a}:{b}" for k in CRF_KINDS for kind, a, b in sorted(free, key=lambda x: x[1]) if kind == k]
    digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
    return (*(len(base[k]) for k in BASE_KINDS), digest, ",".join(listed + more), len(more))


def _free(extra: list[tuple[str, int, int]], taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """The same for many base spans: one merge over both lists."""
    out, at, reach, k = [], 0, -1, sorted(extra, key=lambda x: x[1])
    for x in k:
        while at < len(taken) and taken[at][0] < x[2]:
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= x[1]:
            out.append(x)
    return out


def scan(docs: DataFrame, crf: Crf | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every document.

    The n_ columns count base spans; the kinds that the CRF adds are named apart
    (CRF_KINDS). Null and empty texts have no spans. Repeated rows are scanned
    alike; an empty table gives an empty result; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    crf = crf or train(training_table())
    slim = docs.select("doc_id", "text")

    def batches(it):
        decoder = Decoder(crf)
        for b in it:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [find(t, x) for t, x in zip(texts, crf_spans(texts, decoder), strict=True)]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5]), pa.array(cols[6], pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_added"],
                )

    return slim.mapInArrow(
        batches,
        f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )
