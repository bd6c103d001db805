"""Folders and options of the jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobContext:
    """Where the jobs read and write below ``root``, and what they need to know about the site."""

    root: str
    server_engines: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ("month", "dt", "engine")
    key: str | None = None
    domain_suffix: str = ".corp.example"
    min_device_engines: int = 18
    min_server_engines: int = 3
    first_day: str = "2015-11-02"
    export_root: str | None = None
    strict_ip: bool = False
    folders: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.folders.get(name, f"{self.root.rstrip('/')}/{name}")
