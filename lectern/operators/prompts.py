"""Requests to a language model, and the text of a result that broke off.

The wording is this library's own; a topic's guidance and the sections of a style are parameters.
Requests are built from their arguments alone, so the same text makes the same request in any task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

PART = "\n\n====\n\n"

#: What a topic's system prompt adds; further topics are given to Prompts.
TOPICS = {"general": "Keep the terms of the lecture's own field and explain each where it first occurs."}
STYLES = {
    "summary": "A summary by topic: what was said, how the concepts hang together, what an examination may ask, what to mind in practice.",
    "study-pack": "A pack for study: topics, likely questions with answers and reasons, and what has to be learnt.",
    "merged": "One document for study that has both the summary and the pack, without saying anything twice.",
}


def _fields(*pairs: tuple[str, str]) -> str:
    return "\n\n".join(f"[{name}]\n{value}" for name, value in pairs) + "\n"


@dataclass(frozen=True)
class Prompts:
    """The requests of one run: style names the sections of the result, topic its guidance."""

    style: str = "summary"
    topic: str = "general"
    sections: tuple[str, ...] = ()
    guidance: str | None = None
    language: str = "Korean"

    def system(self) -> str:
        guide = self.guidance if self.guidance is not None else TOPICS.get(self.topic, TOPICS["general"])
        return (
            f"You edit transcripts of lectures into study texts, written in {self.language} as Markdown.\n"
            f"Topic: {guide}\n"
            f"Form: {STYLES[self.style]}\n"
            "Say only what the transcript supports; where it is unclear, say so.\n"
            "Use the given section titles as they stand, in their order, and nothing beside them.\n"
            "Do not speak of yourself or of this request.\n"
        )

    def chunk(self, name: str, at: int, of: int, text: str, glossary: Sequence[str]) -> str:
        task = f"Part {at} of {of} of one lecture. Note what a later merge of all parts needs, in {self.language}, in four lists: topics, concepts with their meaning, examination points, cautions."
        return _fields(("CHUNK", f"{name} {at}/{of}"), ("GLOSSARY", ", ".join(glossary) or "-"), ("TASK", task), ("TRANSCRIPT", text))

    def merge(self, name: str, at: int, of: int, notes: Sequence[str], glossary: Sequence[str]) -> str:
        task = f"Merge these notes of one lecture into one note with the same four lists, in {self.language}. Join repeats; drop nothing that occurs once only."
        return _fields(("MERGE", f"{name} {at}/{of}"), ("GLOSSARY", ", ".join(glossary) or "-"), ("TASK", task), ("NOTES", PART.join(notes)))

    def _result(self) -> str:
        return "\n\n".join(f"{title}\n- ..." for title in self.sections) or "-"

    def final(self, name: str, notes: Sequence[str], glossary: Sequence[str]) -> str:
        task = f"Write the whole result from these notes, in {self.language}. Fill every section."
        return _fields(("FINAL", name), ("GLOSSARY", ", ".join(glossary) or "-"), ("TASK", task), ("SECTIONS", self._result()), ("NOTES", PART.join(notes)))

    def repair(self, name: str, notes: Sequence[str], glossary: Sequence[str], broken: str) -> str:
        task = f"An earlier result broke off. Write it again from its start to its end, in {self.language}: every section, no open heading, no open list. Shorten items if space runs out."
        return _fields(("REPAIR", name), ("GLOSSARY", ", ".join(glossary) or "-"), ("TASK", task), ("SECTIONS", self._result()), ("BROKEN", broken), ("NOTES", PART.join(notes)))


def partial(stage: str, error: str, result: str, merged: Sequence[str], notes: Sequence[str]) -> str:
    """The text that stands for a result when the quota ran out at a stage: the result so far, else merged notes, else notes."""
    reason = (error.splitlines() or [""])[0].strip()
    head = ["## 부분 결과", f"- 멈춘 단계: `{stage}`", "- 사유: 요청 한도 초과", *([f"- 오류: `{reason}`"] if reason else []), ""]
    if result.strip():
        return "\n".join([*head, result.strip()])
    title, rows = ("통합 노트", merged) if merged else ("구간 노트", notes)
    body = [line for i, note in enumerate(rows, 1) for line in (f"### {title} {i}", note.strip(), "")]
    return "\n".join([*head, *(body or ["- 아직 만들어진 내용이 없습니다."])]).strip()
