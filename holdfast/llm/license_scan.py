"""License statements in whole texts: phrases, and templates with optional and replaceable regions.

A template is written in the public license-matching markup: `<<beginOptional>> ... <<endOptional>>` encloses wording that
may be left out, `<<var;match="regex";words=n>>` stands for one to n words that each match the expression. Templates are
compiled into token automata: one state per place between tokens, edges on a word or an expression, and empty moves
round optional regions. A template is accepted where a run of words leads from its first to its last state, so mandatory
wording has to be there word for word; case, punctuation and white space do not matter.
"""

import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame

from holdfast.llm.common import map_texts
from holdfast.llm.license_texts import TEXTS

# The phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short license statements; whole texts and notices are in license_texts.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0"
        "<<beginOptional>> (the \"License\")<<endOptional>>",
    "mit": "<<beginOptional>>Released<<endOptional>><<beginOptional>>Licensed<<endOptional>> under the"
        "<<beginOptional>> terms of the<<endOptional>> MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files",
    "cc-by-nc": "Licensed under<<beginOptional>> a<<endOptional>><<beginOptional>> Creative Commons<<endOptional>>"
        " CC BY-NC<<beginOptional>> <<var;match=\"[0-9]+\";words=2>><<endOptional>>",
    "cc-by-sa": "Licensed under<<beginOptional>> a<<endOptional>><<beginOptional>> Creative Commons<<endOptional>>"
        " CC BY-SA<<beginOptional>> <<var;match=\"[0-9]+\";words=2>><<endOptional>>",
    "gpl-notice": "This <<var;match=\".+\";words=4>> is licensed under the<<beginOptional>> GNU<<endOptional>>"
        " General Public License<<beginOptional>>, version <<var;match=\"[0-9]+\";words=2>><<endOptional>>",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "copyright": "Copyright<<beginOptional>> (c)<<endOptional>> <<var;match=\"[0-9]{4}\";words=2>>"
        " <<var;match=\".+\";words=6>> All rights reserved",
} | TEXTS

#: Bytes that belong to words; every byte of a character beyond ASCII does.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PART = re.compile(r'<<beginOptional>>|<<endOptional>>|<<var;match="(?P<match>[^"]*)";words=(?P<words>\d+)>>')


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


@dataclass
class Automaton:
    """Edges by state: on words, on expressions, and without a word."""

    words: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    patterns: list[list[tuple[re.Pattern, int]]] = field(default_factory=lambda: [[]])
    empty: list[set[int]] = field(default_factory=lambda: [set()])

    def state(self) -> int:
        self.words.append({})
        self.patterns.append([])
        self.empty.append(set())
        return len(self.words) - 1

    def closed(self, states: set[int]) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state not in out:
                out.add(state)
                todo += self.empty[state]
        return out

    def step(self, states: set[int], word: bytes) -> set[int]:
        reached = {self.words[s][word] for s in states if word in self.words[s]}
        reached |= {to for s in states for pattern, to in self.patterns[s] if pattern.fullmatch(word)}
        return self.closed(reached)

    def run(self, words: list[bytes], at: int) -> int | None:
        """End of the longest run of words from `at` that is accepted."""
        states, last, end = self.closed({0}), len(self.words) - 1, None
        while states:
            if last in states:
                end = at
            if at == len(words):
                break
            states, at = self.step(states, words[at]), at + 1
        return end


def compiled(template: str) -> Automaton:
    made = Automaton()
    now, opened, position = 0, [], 0

    def literal(text: str, now: int) -> int:
        for word in words_of(text.encode()):
            made.words[now][word] = to = made.state()
            now = to
        return now

    for part in _PART.finditer(template):
        now = literal(template[position:part.start()], now)
        position = part.end()
        if part[0] == "<<beginOptional>>":
            opened.append(now)
            made.empty[now].add(to := made.state())
            now = to
        elif part[0] == "<<endOptional>>":
            made.empty[now].add(to := made.state())
            made.empty[opened.pop()].add(to)
            now = to
        else:
            end, pattern = made.state(), re.compile(part["match"].encode())
            for _ in range(int(part["words"])):
                made.patterns[now].append((pattern, to := made.state()))
                made.empty[to].add(end)
                now = to
            now = end
    now = literal(template[position:], now)
    if now != len(made.words) - 1:  # the last state accepts
        made.empty[now].add(made.state())
    return made


@dataclass
class Scanner:
    phrases: dict[str, str]
    templates: dict[str, str]

    def __post_init__(self):
        self.runs = [(phrase.encode().split(), label) for phrase, label in self.phrases.items()]
        self.automata = [(label, compiled(template)) for label, template in self.templates.items()]
        self.openings: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, automaton in self.automata:
            first = automaton.closed({0})
            if any(automaton.patterns[s] for s in first):
                raise ValueError(f"template {label} has to begin with a word")
            for word in {w for s in first for w in automaton.words[s]}:
                self.openings.setdefault(word, []).append((label, automaton))
        self.starts = starts = {run[0] for run, _ in self.runs} | set(self.openings)
        inner = b"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"
        self.start = re.compile(
            b"(?<!%b)(?:%b)(?!%b)" % (inner, b"|".join(map(re.escape, sorted(starts))), inner))

    def scan(self, text: bytes) -> tuple:
        """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of the templates."""
        text = text.lower()
        if not self.start.search(text):
            return len(_WORD.findall(text)), 0, None, None, "", "", 0.0, []
        words = _WORD.findall(text)
        base, labels, places, spans = set(), set(), [], []
        for at in [i for i, word in enumerate(words) if word in self.starts]:
            word = words[at]
            for run, label in self.runs:
                if word == run[0] and words[at:at + len(run)] == run:
                    base.add(label)
                    places.append(at)
            for label, automaton in self.openings.get(word, ()):
                end = automaton.run(words, at)
                if end is not None:
                    labels.add(label)
                    spans.append((label, at, end))
        covered, reached = 0, 0
        for _, start, end in sorted(spans, key=lambda s: s[1:]):
            covered += max(0, end - max(start, reached))
            reached = max(reached, end)
        return (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), covered / len(words), spans,
        )


@lru_cache(maxsize=4)
def scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


def license_scan(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, spans: bool = False,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Labels and places of license statements in each whole text.

    n_base counts the places where the words of a phrase stand in a row, also overlapping ones; first_word and last_word
    are the smallest and largest of them (words from 0), null if there are none. labels are those of phrases and
    accepted templates, score is the share of the words that accepted templates cover; with spans=True, spans lists
    them as `label:start:end`. Texts without words, null and empty ones have no labels and score 0. Rows are treated
    alone, whatever their key; other columns are not read.
    """
    phrases = tuple((PHRASES if phrases is None else phrases).items())
    templates = tuple((TEMPLATES if templates is None else templates).items())

    def work(texts: list[bytes]) -> list[list]:
        found = [scanner(phrases, templates).scan(t) for t in texts]
        columns = [list(c) for c in zip(*found)]
        columns[7] = [[f"{label}:{start}:{end}" for label, start, end in row] for row in columns[7]]
        return columns if spans else columns[:7]

    added = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
             + (", spans array<string>" if spans else ""))
    return map_texts(docs, [key], added, work, text)
