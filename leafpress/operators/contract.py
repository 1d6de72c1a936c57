"""What a book's transcript looks like: markers, section names, numbering.  Defaults are the fixed values of the pilot book."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from leafpress.functions.text import BRACKETS


def _key(s: str) -> str:
    return re.sub(r"\s+", "", s).lstrip(BRACKETS).rstrip(BRACKETS + "：:")


@dataclass(frozen=True)
class Contract:
    number_style: str = "mixed"
    numbering: str = "per_chapter"  # or book_global
    chapter_pattern: str = "^[一二三四五六七八九十]+、"
    subchapter_pattern: str = r"(?U)^(?:（[一二三四五六七八九十]+）|[^\s]{2,8}类)"
    recipe_start: str = "@@RECIPE_START"
    recipe_cont: str = "@@RECIPE_CONT"
    section: str = "@@SECTION"
    step: str = "@@STEP"
    footer: str = "@@FOOTER"
    toc: str = "@@TOC"
    sections: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "ingredients": ("原 料", "原料", "材 料"),
            "main": ("主 料", "主料"),
            "side": ("配 料", "配料"),
            "seasoning": ("调 料", "调料"),
            "method": ("制 法", "制法", "制  法", "做 法"),
            "notes": ("注 释", "注释"),
        }
    )
    groups: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"main": ("主 料：", "主料："), "side": ("配 料：", "配料："), "seasoning": ("调 料：", "调料：")})
    step_number_patterns: tuple[str, ...] = (r"^（\d+）\s*", r"^\d+\.\s*", r"^\(\d+\)\s*")
    step_number_bare: str = r"(?U)^\d{1,3}$"
    recipe_number_pattern: str = r"^\d{1,4}$"
    glossary_pattern: str = r"^([\x{2460}-\x{2473}\x{3251}-\x{32BF}])(?U:\s)*([^：]{1,20})：(.+)$"
    toc_line_pattern: str = r"(?U)[…·]{2,}\s*[（(]?\s*\d{1,3}\s*[）)]?\s*$"

    def section_keys(self) -> dict[str, str]:
        return {_key(s): name for name, spellings in self.sections.items() for s in (*spellings, name)}

    def group_keys(self) -> dict[str, str]:
        return {_key(s): name for name, spellings in self.groups.items() for s in spellings}
