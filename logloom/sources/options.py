"""Where a batch job reads and writes."""

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class BatchOptions:
    """Locations of a batch job; ``from_mapping`` takes them from environment-style keys."""

    # Where the jobs look unless told otherwise.
    namenode: str = "hdfs://master:9000"
    input_path: str = "/logs/windows/Windows.log"
    max_input_rows: int = 0
    output_base: str = "/processed_data"
    mirror_base: str | None = None

    @classmethod
    def from_mapping(cls, settings: Mapping[str, str], input_path: str | None = None) -> "BatchOptions":
        """Keys that are absent keep their defaults; ``input_path`` is the job's own default input."""
        return cls(
            namenode=settings.get("HDFS_NAMENODE", cls.namenode),
            input_path=settings.get("LOG_INPUT_PATH", input_path or cls.input_path),
            max_input_rows=int(settings.get("MAX_INPUT_ROWS", "0")),
            output_base=settings.get("HDFS_OUTPUT_BASE", cls.output_base),
            mirror_base=settings.get("LOCAL_OUTPUT_BASE"),
        )

    @property
    def source(self) -> str:
        return self.namenode + self.input_path

    @property
    def results(self) -> str:
        return self.namenode + self.output_base
