"""What a book goes through, as a plan of named steps: a pure function, so it can be shown before it runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

#: The steps, in order, and the engines that read a language unless others are asked for.
STEPS = ["pages", "ocr", "gt", "eval", "merge", "ingest", "cite", "embed", "db", "translate", "embed-en", "db-en"]
ENGINES = {"pa": ["tesseract-pan", "tesseract-gurmukhi"], "en": ["tesseract"], "hi": ["tesseract"]}
KNOWN = {"tesseract", "tesseract-pan", "tesseract-gurmukhi", "tesseract-hin", "pdftext", "surya", "dotsocr", "indicocr"}


@dataclass(frozen=True)
class Step:
    """``note``: why the step is passed over, or what stops the plan; else it runs with ``args``."""

    name: str
    args: dict = field(default_factory=dict)
    note: str | None = None


def _read(work: dict, engines: list[str], pages: str | None, truth: bool, has_truth: bool) -> list[Step]:
    book = {"book": work["book"]} | ({"pages": pages} if pages else {})
    if unknown := [e for e in engines if e not in KNOWN]:
        raise ValueError(f"unknown engine {unknown[0]}; one of {', '.join(sorted(KNOWN))}")
    steps = [Step("pages", book | ({"bleed": True} if work.get("bleed") else {}))]
    steps += [Step("ocr", book | {"engine": e, "lang": work.get("language", "en")}) for e in engines]
    if truth:
        return [*steps, Step("gt", {"book": work["book"], "sample": 30})]
    measured = Step("eval", {"book": work["book"]}) if has_truth else Step("eval", note=f"skip: {work['book']} has no verified lines, so every engine votes with one weight")
    return [*steps, measured, Step("merge", book)]


def plan(works: list[dict], engines: list[str] | None = None, gpu: tuple[str, ...] = (), truth: bool = False, verified: frozenset[str] = frozenset(), has_corpus: bool = True, translate: bool = True, engine: str = "sarvam", pages: str | None = None) -> list[Step]:
    """Steps for these works (book, work, language, reader); ``verified``: books with ground truth."""
    steps: list[Step] = []
    for w in (w for w in works if (w.get("reader") or "ocr") == "ocr"):
        asked = list(engines or ENGINES.get(w.get("language", "en"), ["tesseract"]))
        steps += _read(w, asked + [e for e in gpu if e not in asked], pages, truth, w["book"] in verified)
    if truth:
        return [*steps, Step("gt", note="STOP: verify the candidates, promote them, then go on from eval")]
    steps.append(Step("ingest"))
    steps.append(Step("cite") if has_corpus else Step("cite", note="skip: no corpus, so quotations are not resolved"))
    langs = list(dict.fromkeys(w.get("language", "en") for w in works))
    steps += [Step(name, {"lang": lang}) for lang in langs for name in ("embed", "db")]
    foreign = {w["work"]: w for w in reversed(works) if w.get("language", "en") != "en"}
    if foreign and translate:
        order = dict.fromkeys(w["work"] for w in works if w["work"] in foreign)
        steps += [Step("translate", {"work": w, "src_lang": foreign[w].get("language", "pa"), "engine": engine}) for w in order]
        steps += [Step("embed-en", {"lang": "en", "translations": True}), Step("db-en")]
    elif foreign:
        steps.append(Step("translate", note=f"skip: {'/'.join(x for x in langs if x != 'en')} text stays searchable in its own language only"))
    return steps


def between(steps: list[Step], first: str | None = None, last: str | None = None) -> list[Step]:
    lo, hi = STEPS.index(first or STEPS[0]), STEPS.index(last or STEPS[-1])
    return [s for s in steps if lo <= STEPS.index(s.name) <= hi]


def render(steps: list[Step]) -> str:
    return "\n".join(f"{s.name:10s} {s.note or ' '.join(f'{k}={v}' for k, v in s.args.items())}".rstrip() for s in steps)


def run(steps: list[Step], jobs: dict[str, Callable[..., None]]) -> str | None:
    """Runs each step's job; stops at the first that fails and returns where to go on from, or None."""
    for s in steps:
        if s.note:
            if s.note.startswith("STOP"):
                return s.name
            continue
        try:
            jobs[s.name](**s.args)
        except Exception as e:
            raise RuntimeError(f"{s.name} failed; go on with first={s.name!r}") from e
    return None
