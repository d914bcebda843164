"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass
class Settings:
    mill: str
    region: str
    dates: list[str] = field(default_factory=list)
    products: list[str] = field(default_factory=list)
    country: str = ""
    company: str = ""
    publish: bool = False
    start: str = ""
    end: str = ""
    area: str = ""

    @classmethod
    def read(cls, env: Mapping[str, str] | None = None) -> Settings:
        """MILL and REGION are required; lists are comma lists; a switch is on for true, 1 or yes; START, END and AREA bound the days and name the area's file."""
        e = os.environ if env is None else env
        lacking = [k for k in ("MILL", "REGION") if not e.get(k)]
        if lacking:
            raise ValueError(f"missing settings: {', '.join(lacking)}")
        many = lambda k: [x.strip() for x in e.get(k, "").split(",") if x.strip()]
        return cls(e["MILL"].replace("_", " "), e["REGION"], many("DATES"), many("PRODUCTS"), e.get("COUNTRY", ""), e.get("COMPANY", ""), e.get("PUBLISH", "").lower() in ("true", "1", "yes"), e.get("START", ""), e.get("END", ""), e.get("AREA", ""))

    @property
    def file_key(self) -> str:
        return self.mill.replace(" ", "_")
