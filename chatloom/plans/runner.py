"""Stages with manifests: a stage runs again only when its inputs changed."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from ..storage import Folder


class MissingInput(RuntimeError):
    pass


@dataclass
class Stage:
    number: int
    name: str
    run: Callable[[dict[str, Any]], dict[str, Any]]
    needs: list[str] = field(default_factory=list)
    outputs: list[str] = field(default_factory=list)


@dataclass
class Runner:
    """Runs stages in a folder of its own; ``fingerprint`` stands for all inputs and settings."""

    folder: Folder
    stages: list[Stage]
    fingerprint: dict[str, Any]
    tries: int = 1

    def manifest(self, stage: Stage) -> str:
        return f"stage{stage.number}.done"

    def valid(self, stage: Stage) -> bool:
        try:
            return json.loads(self.folder.text(self.manifest(stage)) or "{}")["fingerprint"] == self.fingerprint
        except (ValueError, KeyError):
            return False

    def invalidate(self, stage: Stage) -> None:
        inputs = {n for s in self.stages for n in s.needs if s.number <= stage.number}
        for name in stage.outputs:
            if name not in inputs:
                self.folder.delete(name)
        self.folder.delete(self.manifest(stage))

    def chosen(self, first: int = 1, last: int | None = None, force: bool = False, only: int | None = None) -> list[Stage]:
        """The stages that a run would do: those asked for that aren't done for these inputs."""
        asked = [s for s in self.stages if (s.number == only if only is not None else first <= s.number <= (last or s.number))]
        return [s for s in asked if force or not self.valid(s)]

    def run(self, first: int = 1, last: int | None = None, force: bool = False, only: int | None = None) -> dict[int, dict[str, Any]]:
        out = {}
        for stage in self.chosen(first, last, force, only):
            self.invalidate(stage)
            missing = [n for n in stage.needs if not self.folder.exists(n)]
            if missing:
                raise MissingInput(f"stage {stage.number} ({stage.name}) needs {', '.join(missing)}; run the stages before it")
            for left in range(self.tries - 1, -1, -1):
                try:
                    result = stage.run(self.fingerprint)
                    break
                except (OSError, TimeoutError):  # anything else, a spent budget above all, ends the run
                    if not left:
                        raise
            self.folder.put(self.manifest(stage), json.dumps({"fingerprint": self.fingerprint, "outputs": stage.outputs, "result": result}, ensure_ascii=False, indent=2))
            out[stage.number] = result
        return out

    def restart(self, keep: tuple[str, ...] = ()) -> None:
        """Forget all stages: their outputs and manifests go, other files of the folder and those to ``keep`` stay."""
        for stage in self.stages:
            for name in stage.outputs:
                if name not in keep:
                    self.folder.delete(name)
            self.folder.delete(self.manifest(stage))
