"""Where a streaming job keeps its lake, its state and its checkpoints."""

from dataclasses import dataclass

from convoy.sources.lake import dead_letter_path, lake_path


@dataclass(frozen=True)
class Layout:
    """``lakes`` are the roots to write the same lake to: one, or several for a dual write.

    All paths must be on storage that every executor shares. With ``hold_seconds`` positions are held so
    long for those that arrive out of order, see ``write_ordered_lake``.
    """

    lakes: list[str]
    work: str
    trigger_seconds: int = 10
    state_trigger_seconds: int = 5
    hold_seconds: int | None = None

    def events(self, event_type: str) -> list[str]:
        return [lake_path(root, event_type) for root in self.lakes]

    def dead_letters(self) -> list[str]:
        return [dead_letter_path(root) for root in self.lakes]

    def checkpoint(self, query_name: str, target: int = 0) -> str:
        """Every query, and every target of it, has a checkpoint of its own."""
        suffix = "" if target == 0 else f"_{target}"
        return f"{self.work.rstrip('/')}/checkpoints/{query_name}{suffix}"

    def state(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/state/{name}"

    def commits(self, name: str) -> str:
        """Records of the batches that are in all targets."""
        return f"{self.work.rstrip('/')}/commits/{name}"
