"""The scheduled Bronze-to-Silver run, in dependency order."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from mercato.lakehouse import Lakehouse, TableChanged
from mercato.operators.merge import merge_into
from mercato.schemas import ENTITIES


def _graph(entities: Iterable[str] | None) -> TopologicalSorter:
    wanted = set(ENTITIES if entities is None else entities)
    return TopologicalSorter({n: [a for a in ENTITIES[n].after if a in wanted] for n in ENTITIES if n in wanted})


def merge_order(entities: Iterable[str] | None = None) -> list[str]:
    """Entities so that each comes after those it refers to."""
    return list(_graph(entities).static_order())


def bronze_to_silver(lake: Lakehouse, entities: Iterable[str] | None = None, retries: int = 2,
                     at_once: int = 4, **how) -> list[str]:
    """Merge the named entities (default all eight).

    Entities that do not wait for each other run as concurrent Spark jobs; each
    is tried again up to ``retries`` times if another writer was faster or storage failed.
    """
    def run(name: str) -> str:
        for attempt in range(retries + 1):
            try:
                merge_into(lake, name, **how)
                return name
            except (TableChanged, OSError):
                if attempt == retries:
                    raise

    waiting, done, running = _graph(entities), [], set()
    waiting.prepare()
    with ThreadPoolExecutor(at_once) as pool:
        while waiting.is_active():
            running |= {pool.submit(run, name) for name in waiting.get_ready()}
            over, running = wait(running, return_when=FIRST_COMPLETED)
            for name in sorted(f.result() for f in over):
                done.append(name)
                waiting.done(name)
    return done
