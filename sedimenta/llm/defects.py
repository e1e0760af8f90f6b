"""Problem 6: defective answers.

An answer is cut into clauses (sentences, list items, blocks of code). A linear-chain conditional random field tags each
clause as answer, refusal, echo of the instruction, foreign, unfinished or empty; the share of the answer that each tag
covers decides the defect of the pair. The field is trained on answers of the table itself and damaged copies of them:
what was done to a copy tells its tags, and the features are never asked. Features are words and word pairs, overlap with
the instruction, likelihoods under letter models of languages, and the state of the last line.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import languages, seeds

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished", "empty")
A, R, E, X, U, N = range(6)
#: Most pairs taken to train on, those of the smallest hash of their text; all pairs are tagged.
MAX_TRAINING = 1_500
#: Most clauses, and characters, of an answer to train on; answers of any length are tagged whole.
MAX_CLAUSES, MAX_TRAINING_CHARS = 24, 4_000
#: Damaged copies are as many as sound answers in training but few in a table: nats by which a last clause must be likelier unfinished than not.
RARE = 1.0
#: Nats by which a clause must be likelier sound than not for its pair to count as sound in training.
DOUBT = 1.0
#: Share of an answer's letters and digits that echoes, refusals or empty notes must cover.
COVERED = 0.9
#: Share of an answer's prose that must be foreign.
FOREIGN_SHARE = 0.5
#: How many nats less likely than its likeliest language an instruction may be in a language that answers may have.
SAME_LANGUAGE = 4.0

_MARKUP = re.compile(r"<[^<>\n]*>|&(?:\w+|#\d+);|```\w*")
_FENCE = re.compile(r"```[^\n`]*(?:\n|$)")
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\"'”’»)]*\s+(?=\S)|(?<=[。！？])(?=\S)")
_ITEM = re.compile(r"^\s*(?:[-*+•]|\d+[.)])\s")
_TICKS = re.compile(r"`[^`\n]*`|\b\w*[_\d]\w*\b|\w+\(\)")
_CODE_START = re.compile(r"""\s*(?:def |class |public |private |package |export |const |let |var |function |async |#include|#define|pub |fn |func |#!/|select\s|with \w+ as|insert |update \w+ set|delete from|create |--- |diff |@@ |\{\s*(?:["'\d}\n]|\w+\s*:)|\[\s*[\[{"'\d]|import |from \w+ import|int |void |static |module |struct |type \w+ |use |using |@\w+|git |<\w+>)""", re.I)
_CODE_SIGN = re.compile(r"[{}();=\[\]<>]|:\s*\n|:$|\n")
_LABEL = re.compile(r"[\W_]*[^\W\d_]+(?: [^\W\d_]+)?[\W_]*:[\W_]*(?=\w)")
_STRINGS = re.compile(r'"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'|`[^`]*`|(?<!\S)(?:#|//|--) [^\n]*|/\*.*?\*/')
_OTHER = re.compile(r"[\W_]+")
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_TOKENS = re.compile(r"\w+")
_LAST = re.compile(r"\w+$")
_NAME_IS = re.compile(r"(?:(?:let|const|var|final|auto|int|long|double|float|bool|char|string|mut) +)*\w+(?: *: *[\w\[\]<>, ]+)? *(?:[-+*/%|&:]|<<|>>)?= *\S", re.I)
_PLACE_IS = re.compile(r"[\w.\[\]'\"]+ *[-+*/]?= *\S")
_CALL = re.compile(r"[\w.:>\-!]+ ?\(.*\)[;,]?$")
_LEAVES = re.compile(r"(?:return|yield|raise|throw|exit|pass|break|continue)\b")
_CLOSES = frozenset("end fi done esac pass break continue ... end; fi; done;".split())
_OPENS = re.compile(r"\b(?:def|class|module|do|begin|if|case|unless)\b", re.I)
_ENDS = re.compile(r"\bend\b", re.I)
_GROUPS = (
    ("diff", re.compile(r"(?:--- |diff |@@ )")), ("shell", re.compile(r"#!|(?:git|cd|make|sudo|export \w+=) ?")), ("sql", re.compile(r"(?:select|with|insert|create|update|delete)\s", re.I)), ("data", re.compile(r"[{\[]")), ("ends", re.compile(r"(?:def|class|module|require) ?[^:{]*(?:\n|$)", re.I)),
    ("python", re.compile(r"(?:def|class|from|import|async def|@\w+)\b", re.I)), ("markup", re.compile(r"<")),
)


def fold(text: str) -> str:
    """Letters and digits only, case folded."""
    return _OTHER.sub("", text).casefold()


def is_code(text: str) -> bool:
    return bool(_CODE_START.match(text) and _CODE_SIGN.search(text)) and len(text.strip()) > 12


def clauses(output: str) -> list[tuple[str, str]]:
    """(kind, text) in order; kind is code, open (a fence that is never closed), item or prose, or blank for all of a text without any."""
    out: list[tuple[str, str]] = []
    parts = _FENCE.split(output) if "```" in output else [output]
    for i, part in enumerate(parts):
        if i % 2:
            if part.strip():
                out.append(("open" if i == len(parts) - 1 else "code", part))
            elif i == len(parts) - 1:
                out.append(("open", "```"))
        elif is_code(part):
            out.append(("code", part))
        else:
            for line in part.splitlines():
                if line.strip():
                    if _ITEM.match(line):
                        out.append(("item", line))
                    else:
                        out += [("prose", s) for s in _SENTENCE.split(line) if s and s.strip()]
    return out or [("blank", output)]


def _prose(instruction: str) -> str:
    """An instruction without the code below it."""
    lines = instruction.split("\n")
    for i in range(1, len(lines)):
        if lines[i].startswith("```") or _CODE_START.match(lines[i]) and is_code("\n".join(lines[i:])):
            return "\n".join(lines[:i])
    return instruction


def words_of(text: str) -> list[str]:
    return _WORDS.findall(_TICKS.sub(" ", text).casefold())


def _bin(x: float, bounds: tuple) -> int:
    return sum(x >= b for b in bounds)


class Reader:
    """Clauses as features. ``counts`` says in how many training pairs a word occurs; ``least`` is from when it is known."""

    def __init__(self, counts: dict[str, int], least: int = 1) -> None:
        self.counts, self.least = counts, least
        self.starts = {w[:i] for w, n in counts.items() if n >= 2 for i in range(1, len(w))}
        self.profiles, self.asked, self.done = languages.Profiles(), {}, None

    def ask(self, instruction: str) -> tuple[str, np.ndarray | None, frozenset]:
        """The folded instruction, which languages an answer to it may have, and its tokens."""
        got = self.asked.get(instruction)
        if got is None:
            words = [w for k, t in clauses(_prose(instruction)) if k in ("prose", "item") for w in words_of(t)] or words_of(instruction)
            may = None
            if words:
                likely = self.profiles.sum(words)
                may = likely >= likely.max() - SAME_LANGUAGE
                may[list(languages.named(instruction.casefold()))] = True
            if len(self.asked) > 50_000:
                self.asked.clear()
            got = self.asked[instruction] = (fold(instruction), may, frozenset(_TOKENS.findall(instruction.casefold())))
        return got

    def _echo(self, own: str, folded: str) -> float:
        """The share of a folded clause that stands in the folded instruction; of a short one, whether all does."""
        n = len(own) - 7
        if n < 5:
            return float(bool(own) and own in folded)
        if sum(own[j : j + 8] in folded for j in range(0, n, max(1, n // 5))) < 2:
            return 0.0
        at = range(0, n, max(1, n // 60))
        return sum(own[j : j + 8] in folded for j in at) / len(at)

    def _token(self, text: str, tokens: frozenset) -> str:
        """What is known of the word that the text ends with."""
        found = _LAST.search(text)
        if not found:
            return "none"
        last = found[0].casefold()
        if last.isdigit():
            return "number"
        seen = Counter(_TOKENS.findall(text.casefold()))
        if seen[last] > 1 or last in tokens:
            return "seen"
        known = self.counts.get(last, 0) >= self.least
        if any(t.startswith(last) for t in seen if t != last) or any(t.startswith(last) for t in tokens):
            return "known start" if known else "start"
        return "known" if known else "likely start" if last in self.starts else "new"

    def _code_end(self, text: str, tokens: frozenset) -> list[str]:
        code = text.strip()
        lines = code.split("\n")
        last = lines[-1].strip()
        group = next((g for g, p in _GROUPS if p.match(code)), "other")
        if group == "diff":
            last = last[1:].strip() if last[:1] in "+-" else last
            code_ = last
        else:
            code_ = code
        balance = [code_.count(a) - code_.count(b) for a, b in ("()", "[]", "{}")]
        if any(balance):  # brackets in texts and comments don't count, unless they make up for others
            bare = _STRINGS.sub("", code_)
            balance = min(balance, [bare.count(a) - bare.count(b) for a, b in ("()", "[]", "{}")], key=lambda b: sum(map(abs, b)))
        token, sign = self._token(code, tokens), code[-1:] if code and not code[-1].isalnum() else "a"
        sign = "stub" if last.endswith((": ...", "{ ... }")) or last == "..." else sign
        out = [f"ce {group}", f"cs {sign}", f"cs {sign} {group}", f"ct {token}", f"ct {token} {group}", f"cl {chr(10) in text[len(text.rstrip()) :]}", f"c1 {len(lines) == 1}"]
        opened = max(balance)
        out += [f"cb {min(opened, 2)}", f"cb {min(opened, 2)} {group}", f"cn {min(balance) < 0}", f"cq {last.count(chr(34)) % 2} {last.count(chr(39)) % 2}"]
        if group == "diff":
            return out
        if last.startswith(("#", "//", "--", "/*", "*")):
            kind = "comment"
        else:
            body = re.sub(r"\s+(?:#|//) .*$", "", last)
            if not body.strip("})];, "):
                kind = "closer"
            elif body.casefold() in _CLOSES or body.endswith(": ..."):
                kind = "close word"
            elif _LEAVES.match(body.casefold()):
                kind = "leaves" if len(body.split()) > 1 or body.rstrip(";").casefold() in _CLOSES else "leaves bare"
            elif body.endswith((":", "{", "(", "[", " do", " then", ",", "=", "+", "&&", "||", "<", ">")):
                kind = "open " + body[-1]
            elif _NAME_IS.match(body):
                kind = "name is"
            elif _PLACE_IS.match(body):
                kind = "place is"
            else:
                kind = "call" if _CALL.match(body) else "other"
        inside = lines[-1][:1] in " \t"
        out += [f"ck {kind}", f"ck {kind} {inside}", f"ck {kind} {group}", f"ci {inside} {group}"]
        if group == "ends":
            out.append(f"cd {_bin(len(_OPENS.findall(code)) - len(_ENDS.findall(code)), (1, 2))}")
        if group == "shell":
            tokens_ = Counter(_TOKENS.findall(code))
            out.append(f"ch {tokens_['then'] > tokens_['fi'] or tokens_['do'] > tokens_['done']}")
        if code.count(";\n") >= 2 and kind not in ("closer", "comment"):
            out.append(f"cm {last.endswith(';')}")
        return out

    def _prose_end(self, kind: str, text: str, words: list[str], before: str, tokens: frozenset, newline: bool) -> list[str]:
        end = text.rstrip()
        sign = "dots" if end.endswith(("…", "...")) else "digit" if end[-1:].isdigit() else "letter" if end[-1:].isalpha() else end[-1:]
        heading, few = end.lstrip()[:1] == "#", _bin(len(words), (1, 2, 4, 8))
        out = [f"ps {sign}", f"ps {kind} {sign}", f"pn {sign} {few}", f"ph {heading}", f"po {end.count('`') % 2} {end.count('(') > end.count(')')} {end.count(chr(34)) % 2}"]
        if sign in ("letter", "digit", ","):
            token = self._token(end, tokens)
            out += [f"pw {token}", f"pk {kind} {sign} {token}", f"pt {newline or text[-1:].isspace()}", f"pb {before} {sign} {few}"]
            if words:
                out.append(f"pe {words[-1]}")
        return out

    def read(self, instruction: str, output: str) -> tuple[list[str], list[list[str]], list[int], list[str]]:
        """Kinds, features, sizes and word features of the clauses."""
        folded, may, tokens = self.ask(instruction)
        found = clauses(output)
        fenced, n = "```" in output, len(found)
        kinds, feats, sizes, grams = [], [], [], []
        texts = [words_of(t) if k != "code" and k != "open" else [] for k, t in found]
        margins, whole = [None] * n, None
        if may is not None and not may.all():
            total = np.zeros(len(languages.LANGUAGES), dtype=np.float32)
            for i, ws in enumerate(texts):
                if ws:
                    v = self.profiles.sum(ws)
                    total += v
                    margins[i] = float(v[~may].max() - v[may].max())
            if total.any():
                whole = float(total[~may].max() - total[may].max())
        bounds = (-30, -12, -5, 0, 5, 12, 30)
        before = "none"
        for i, (kind, text) in enumerate(found):
            own, ws, last = fold(text), texts[i], i == n - 1
            sizes.append(len(own) or 1)
            echo = self._echo(own, folded)
            if 0.1 < echo < 0.97 and (label := _LABEL.match(text)):
                echo = max(echo, self._echo(fold(text[label.end() :]), folded))
            f = ["bias", f"k {kind}", f"e {_bin(echo, (0.6, 0.85, 0.97))} {len(own) < 12}", f"at {min(i, 2)} {last}", f"n {min(n, 4)}"]
            if echo >= 0.6:
                f.append(f"er {_bin(len(own) / (len(folded) + 1), (0.3, 0.7, 1.3))}")
            if len(own) < 40:
                f.append(f"x {bool(fold(_MARKUP.sub(' ', text)))} {kind} {min(n, 3)}")
            if kind in ("prose", "item", "blank"):
                f.append(f"w {_bin(len(ws), (1, 2, 3, 5, 8))}")
                if margins[i] is not None:
                    a, b = _bin(margins[i], bounds), _bin(whole, bounds)
                    f += [f"l {a}", f"lw {b}", f"ll {a} {b}"]
                if len(own) < 40 and n <= 2:  # what may be no answer at all
                    plain = text.strip()
                    f += [f"xc {plain[-1:] == ':'} {plain[:1] in '#*=' and bool(plain)} {_bin(len(ws), (1, 2, 3))} {n}", f"xb {plain[:1] in '[(<' and bool(plain)} {plain.isupper()}", f"xd {any(c.isdigit() for c in plain)}", f"xs {' '.join(ws)}"]
                grams.append([f"u {w}" for w in ws] + [f"b {a} {b}" for a, b in zip(["^", *ws], [*ws, "$"])])
            else:
                grams.append([])
            if last:
                if kind == "code" and fenced:
                    f.append("closed")
                elif kind in ("code", "open"):
                    f += self._code_end(text, tokens)
                else:
                    f += self._prose_end(kind, text, ws, before, tokens, output[-1:] == "\n")
            if kind == "prose":
                before = "stop" if text.rstrip()[-1:] in ".!?:;。" else "run"
            elif kind == "item":
                before = "item"
            kinds.append(kind)
            feats.append(f)
        return kinds, feats, sizes, grams


Sequence = tuple[list[list[str]], list[list[str]], list[int]]


class Field:
    """Linear-chain conditional random field over sparse features."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray, start: np.ndarray, counts: dict[str, int]) -> None:
        self.names, self.emit, self.move, self.start, self.counts = names, emit, move, start, counts

    @staticmethod
    def flatten(names: dict[str, int], feats: list[list[str]], grams: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, their values, and where each clause begins; words share their weight by the root of their number."""
        at, value, starts, get = [], [], [], names.get
        for f, g in zip(feats, grams):
            starts.append(len(at))
            own = [j for x in f if (j := get(x)) is not None]
            ws = [j for x in g if (j := get(x)) is not None]
            at += own or [0]
            value += [1.0] * (len(own) or 1)
            if ws:
                at += ws
                value += [2.5 / len(g) ** 0.5] * len(ws)
        return np.array(at, dtype=np.int64), np.array(value, dtype=np.float32), np.array(starts, dtype=np.int64)

    @classmethod
    def train(cls, sequences: list[Sequence], counts: dict[str, int], steps: int = 100, penalty: float = 4e-5) -> Field:
        seen = Counter(x for feats, grams, _ in sequences for f, g in zip(feats, grams) for x in {*f, *g})
        names = {"bias": 0}
        for x in sorted(x for x, n in seen.items() if n >= 3):
            names.setdefault(x, len(names))
        n, k = len(sequences), len(TAGS)
        theta = [np.zeros((len(names), k), dtype=np.float32), np.zeros((k, k)), np.zeros(k)]
        if not n:
            return cls(names, *theta, counts)
        at, value, starts = cls.flatten(names, [f for s in sequences for f in s[0]], [g for s in sequences for g in s[1]])
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
        order = np.argsort(at, kind="stable")
        used, first = np.unique(at[order], return_index=True)
        by_value, by_clause = value[order], of[order]
        tags = np.array([g for s in sequences for g in s[2]])
        ends = np.cumsum([len(s[2]) for s in sequences])
        lengths = np.diff(np.append(0, ends))
        groups = [(ends[lengths == t] - t)[:, None] + np.arange(t) for t in np.unique(lengths)]  # clauses of the sequences of one length
        m, v, mean = ([np.zeros_like(p) for p in theta] for _ in range(3))

        def back(per_clause: np.ndarray) -> np.ndarray:
            out = np.zeros_like(theta[0])
            out[used] = np.add.reduceat(np.ascontiguousarray(per_clause.T)[:, by_clause] * by_value, first, axis=1).T
            return out

        gold = np.eye(k, dtype=np.float32)[tags]
        want = [back(gold), sum(np.einsum("ntj,ntk->jk", gold[g[:, :-1]], gold[g[:, 1:]]) for g in groups), sum(gold[g[:, 0]].sum(0) for g in groups)]
        for step in range(1, steps + 1):
            e = np.add.reduceat(np.ascontiguousarray(theta[0].T)[:, at] * value, starts, axis=1).T
            e = np.exp(e - e.max(axis=1, keepdims=True))
            move, start = np.exp(theta[1] - theta[1].max()), np.exp(theta[2] - theta[2].max())
            p, pair = np.zeros_like(e), np.zeros((k, k))
            for g in groups:
                own, t = e[g], g.shape[1]
                ahead, norm = [start * own[:, 0]], []
                for j in range(t):
                    if j:
                        ahead.append((ahead[-1] @ move) * own[:, j])
                    norm.append(ahead[j].sum(axis=1, keepdims=True) + 1e-30)
                    ahead[j] = ahead[j] / norm[j]
                behind = np.ones_like(ahead[0])
                for j in range(t - 1, -1, -1):
                    p[g[:, j]] = ahead[j] * behind
                    if j:
                        next_ = own[:, j] * behind / norm[j]
                        pair += move * (ahead[j - 1].T @ next_)
                        behind = next_ @ move.T
            have = [back(p.astype(np.float32)), pair, sum(p[g[:, 0]].sum(0) for g in groups)]
            for i in range(3):
                g = (have[i] - want[i]) / n + penalty * theta[i]
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.99 * v[i] + 0.01 * g * g
                theta[i] = (theta[i] - 0.12 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-6)).astype(theta[i].dtype)
                if 2 * step > steps:
                    mean[i] += theta[i] / (steps - steps // 2)
        return cls(names, *mean, counts)

    def tag(self, rows: list[tuple[list[list[str]], list[list[str]]]], doubt: float = 0.0) -> list[list[int]]:
        """The most probable tags of each answer; answers of one length are worked through together. ``doubt`` in nats speaks against sound ones."""
        at, value, starts = self.flatten(self.names, [f for r in rows for f in r[0]], [g for r in rows for g in r[1]])
        if not len(starts):
            return [[] for _ in rows]
        e = np.add.reduceat(self.emit[at] * value[:, None], starts, axis=0)
        e[:, U] -= RARE if not doubt else 0.0
        e[:, A] -= doubt
        lengths = np.array([len(r[0]) for r in rows])
        ends = np.cumsum(lengths)
        out: list[list[int]] = [[] for _ in rows]
        for t in np.unique(lengths):
            who = np.flatnonzero(lengths == t)
            own = e[(ends[who] - t)[:, None] + np.arange(t)]
            score, back = self.start + own[:, 0], []
            for j in range(1, t):
                step = score[:, :, None] + self.move
                back.append(step.argmax(1))
                score = step.max(1) + own[:, j]
            path = [score.argmax(1)]
            for b in reversed(back):
                path.append(b[np.arange(len(who)), path[-1]])
            for w, tags in zip(who, np.stack(path[::-1], axis=1).tolist()):
                out[w] = tags
        return out


def _refusal(rng: np.random.Generator, tongue: str, instruction: str) -> str:
    openings, bodies, closes = seeds.REFUSALS[tongue]
    pick = lambda xs, p: xs[int(rng.integers(len(xs)))] if rng.random() < p else ""
    body = pick(bodies, 1)
    opening = pick(openings, 0.6)
    if not opening:
        body = body[0].upper() + body[1:]
    before = pick(seeds.RESTATED[tongue], 0.25)
    ticks = re.search(r"`[^`\n]+`", instruction)
    if before and ticks and rng.random() < 0.7:
        before = before.rstrip(".").rsplit(" ", 1)[0] + f" {ticks[0]}."
    return pick(("# ", "\n", "> "), 0.1) + " ".join(x for x in (before, opening, body, pick(closes, 0.45)) if x)


def _note(rng: np.random.Generator) -> str:
    """A text that is no answer."""
    kind = rng.integers(4)
    if kind == 0:
        return str(rng.choice(["", " ", "\n\n", "-", "—", "...", "…", "???", "!", "\t\n", '""', "''", "``", "​", "\xa0", "***", "---", "[]", "{}", "()", "_", "."]))
    if kind == 1:
        tag = str(rng.choice(["p", "div", "span", "br/", "li", "code", "td"]))
        return str(rng.choice([f"<{tag}></{tag}>", f"<{tag}>\n</{tag}>", f"<{tag}>", "&nbsp;", "```\n```", "```\n\n```", "```python\n```", "```sql\n\n```", "&#160;", f"<{tag}>\n<{tag}>"]))
    if kind == 2:
        label = str(rng.choice(seeds.LABELS))
        return str(rng.choice([f"{label}:", f"{label}:\n", f"## {label}", f"# {label}\n", f"**{label}**", f"**{label}:**", f"### {label}:", label.upper() + ":"]))
    note = str(rng.choice(seeds.NOTES))
    note = str(rng.choice([note, note, note.upper(), note.capitalize(), note + "."]))
    return str(rng.choice([note, note, f"[{note}]", f"({note})", f"<{note}>", f"*{note}*", f"{note}\n"]))


def _cut(rng: np.random.Generator, text: str) -> str | None:
    """The text broken off at a random place, or None where that does no damage: after a whole clause, or in an answer of a few words."""
    if len(text.strip()) < 40:
        return None
    at = int(len(text) * (rng.uniform(0.1, 0.98) if rng.random() < 0.7 else rng.uniform(0.8, 0.99)))
    if rng.random() < 0.5:  # after a token
        found = re.match(r"\w*\s*", text[at:])
        at += found.end() if found else 0
    cut = text[:at]
    if len(cut.strip()) < 20 or at >= len(text.rstrip()):
        return None
    whole, part = [c[1].strip() for c in clauses(text)], [c[1].strip() for c in clauses(cut)]
    if part == whole[: len(part)] and not (len(whole) == 1):
        return None
    if rng.random() < 0.2 and text[at - 1 : at].isalpha():
        cut += str(rng.choice(["...", "…", ","]))
    return cut


def examples(pairs: list[tuple[str, str]], reader: Reader, clean: list[bool] | None = None, seed: int = 7) -> list[Sequence]:
    """Training sequences: pairs as they are, and damaged ones whose clause tags are known from the damage done.

    Without ``clean`` all pairs count as sound, the few defective ones of the table included; with it only those marked.
    """
    rng = np.random.default_rng(seed)
    out: list[Sequence] = []

    def add(instruction: str, output: str, tag) -> None:
        got = reader.done.get((instruction, output)) if reader.done is not None else None
        if got is None:
            got = reader.read(instruction, output)
            if reader.done is not None:
                reader.done[instruction, output] = got
        kinds, feats, _, grams = got
        if len(kinds) <= MAX_CLAUSES:
            out.append((feats, grams, tag(kinds)))

    every = lambda tag: lambda kinds: [tag] * len(kinds)
    sound = [p for i, p in enumerate(pairs) if clean is None or clean[i]]
    tongues: dict[int, list[str]] = {}
    for _, output in sound:
        ws = [w for k, t in clauses(output) if k in ("prose", "item") for w in words_of(t)]
        if len(ws) >= 6:
            tongues.setdefault(int(reader.profiles.sum(ws).argmax()), []).append(output)
    common = [k for k, v in tongues.items() if len(v) >= max(3, 0.01 * len(sound))]
    samples = {k: _SENTENCE.split(v) for k, v in languages.SAMPLES.items()}
    names = list(samples)
    refused = list(seeds.REFUSALS)
    for instruction, output in sound:
        add(instruction, output, every(A))
        folded, may, _ = reader.ask(instruction)
        damage = rng.random(5)
        if damage[0] < 0.7:
            own = [k for k in refused if may is not None and may[languages.LANGUAGES.index(k)]]
            add(instruction, _refusal(rng, str(rng.choice(own)) if own and rng.random() < 0.8 else str(rng.choice(refused)), instruction), every(R))
        if folded and damage[1] < 0.35:
            said = [instruction, instruction.upper(), instruction.lower(), f"“{instruction}”", f'"{instruction}"', f"> {instruction}", f"{rng.choice(seeds.ECHO_LABELS)}: {instruction}", f"**{rng.choice(seeds.ECHO_LABELS)}:** {instruction}", f"{instruction}\n{instruction}", re.sub(r"[`.?!:]", "", instruction), f"  {instruction}\n"]
            add(instruction, said[int(rng.integers(len(said)))], every(E))
        elif folded and damage[1] < 0.5 and "```" not in instruction and not is_code(output):
            first = clauses(instruction)
            text = f"{instruction}\n\n{output}"
            if [c[1] for c in clauses(text)[: len(first)]] == [c[1] for c in first]:
                add(instruction, text, lambda kinds, n=len(first): [E] * n + [A] * (len(kinds) - n))
        if may is not None and not may.all() and damage[2] < 0.4:
            others = [k for k in common if not may[k]]
            if others and rng.random() < 0.7:
                texts = tongues[others[int(rng.integers(len(others)))]]
                add(instruction, texts[int(rng.integers(len(texts)))], lambda kinds: [A if k in ("code", "open") else X for k in kinds])
            else:
                name = str(rng.choice([k for k in names if not may[languages.LANGUAGES.index(k)]]))
                at = int(rng.integers(len(samples[name])))
                add(instruction, " ".join(samples[name][at : at + 1 + int(rng.integers(3))]), every(X))
        for _ in range(1 + (damage[3] < 0.3)):
            cut = _cut(rng, output)
            if cut:
                add(instruction, cut, lambda kinds: [A] * (len(kinds) - 1) + [U])
        if damage[4] < 0.45:
            add(instruction, _note(rng), every(N))
        elif damage[4] < 0.55:  # an apology before an answer is an answer
            add(instruction, str(rng.choice(["Sorry for the delay, here it is: ", "Unfortunately this is slow, but it works: ", "Sorry, my first version was wrong.\n\n"])) + output, every(A))
    for name, sentences in samples.items():  # answers in the language of their question, whichever it is
        for i, first in enumerate(sentences):
            add(first, sentences[(i + 2) % len(sentences)], every(A))
    return out


def fit(pairs: list[tuple[str, str]], seed: int = 7) -> Field:
    """A field from pairs of the table. Fields of either half tell which pairs of the other seem defective; the last is trained without these."""
    texts = list(dict.fromkeys(pairs))
    sound = list(seeds.SOUND) * 3
    counts = Counter(w for _, o in [*texts, *seeds.SOUND] for w in {x.casefold() for x in _TOKENS.findall(o)} if not w.isdigit())
    reader = Reader(counts, 2)  # a word of the pair itself is known if another pair has it, too
    reader.done = {}  # pairs are used more than once
    clean = [True] * len(texts)
    for half in (0, 1):
        first = Field.train(examples([*texts[half::2], *seeds.SOUND], reader, None, seed), counts, steps=30)
        read = [reader.read(*p) for p in texts[1 - half :: 2]]
        clean[1 - half :: 2] = [all(t == A for t in tags) for tags in first.tag([(f, g) for _, f, _, g in read], DOUBT)]
    return Field.train(examples([*texts, *sound], reader, [*clean, *[True] * len(sound)], seed + 1), counts)


def decide(kinds: list[str], sizes: list[int], tags: list[int], folded: str) -> str | None:
    """The defect of a tagged answer, from what each tag covers; None for a proper answer."""
    cover = [0] * len(TAGS)
    for n, g in zip(sizes, tags):
        cover[g] += n
    total = sum(sizes)
    if cover[N] >= COVERED * total:
        return "empty"
    if cover[E] >= COVERED * total and cover[E] >= 0.5 * len(folded):
        return "copies_question"
    if cover[R] and cover[R] + cover[E] + cover[N] >= COVERED * total:
        return "refusal"
    prose = sum(n for n, k in zip(sizes, kinds) if k in ("prose", "item"))
    if cover[X] and cover[X] >= FOREIGN_SHARE * prose and cover[X] > cover[R]:
        return "other_language"
    return "truncated" if tags[-1] == U else None


def defects(pairs: list[tuple[str | None, str | None]], field: Field, reader: Reader | None = None) -> list[str | None]:
    """The defect of each pair, or None. A null answer is ``empty``; without an instruction nothing is told."""
    reader = reader or Reader(field.counts)
    at = [n for n, (i, o) in enumerate(pairs) if i and i.strip() and o is not None]
    read = [reader.read(*pairs[n]) for n in at]
    out = ["empty" if i and i.strip() and o is None else None for i, o in pairs]
    for n, (kinds, _, sizes, _), tags in zip(at, read, field.tag([(f, g) for _, f, _, g in read])):
        out[n] = decide(kinds, sizes, tags, reader.ask(pairs[n][0])[0])
    return out


def trained(df: DataFrame, most: int = MAX_TRAINING) -> Field:
    """A field trained on at most ``most`` distinct pairs of ``df``, those of the smallest hash of instruction and output."""
    step = max(1, df.count() // (8 * most))  # thins by hash first, so that tasks don't each send a whole sample
    rows = df.select("instruction", "output").filter(f"trim(instruction) <> '' and length(output) between 1 and {MAX_TRAINING_CHARS}").withColumn("h", F.xxhash64("instruction", "output"))
    rows = rows.filter(F.pmod("h", F.lit(step)) == 0).dropDuplicates(["instruction", "output"]).orderBy("h", "instruction", "output").limit(most).collect()
    return fit([(r["instruction"], r["output"]) for r in rows])


def found(df: DataFrame, order: str = "ordinal", most: int = MAX_TRAINING, field: Field | None = None) -> DataFrame:
    """(ordinal, defect) of each row with a non-blank instruction and a defective output; one defect a row.

    Rows with a null or blank instruction take no part. Whole answers are tagged, whatever their length. Repeated rows
    and keys each keep their row.
    """
    shared = df.sparkSession.sparkContext.broadcast(field or trained(df, most))

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value.counts)
        for pdf in batches:
            for at in range(0, len(pdf), 1_000):
                part = pdf.iloc[at : at + 1_000]
                kinds = defects(list(zip(part["i"], part["o"])), shared.value, reader)
                yield pd.DataFrame({"ordinal": [k for k, x in zip(part["ordinal"], kinds) if x], "defect": [x for x in kinds if x]})

    rows = df.select(F.col(order).cast("long").alias("ordinal"), F.col("instruction").alias("i"), F.col("output").alias("o")).filter("i is not null")
    return rows.mapInPandas(tag, "ordinal long, defect string")
