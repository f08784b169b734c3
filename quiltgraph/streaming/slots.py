"""Statements that read a replication slot and a redo log. ``execute`` runs one and gives its rows as dictionaries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from quiltgraph.functions.names import escape_literal

Execute = Callable[[str], list[dict[str, Any]]]

# Fixed value: change numbers that one look at a redo log covers.
REDO_WINDOW = 50_000


@dataclass(frozen=True)
class Slot:
    name: str
    publication: str

    def ensure(self, execute: Execute) -> None:
        """Make publication and slot where they are missing."""
        if not execute(f"SELECT 1 AS one FROM pg_publication WHERE pubname = '{escape_literal(self.publication)}'"):
            execute(f'CREATE PUBLICATION "{self.publication}" FOR ALL TABLES')
        if not execute(f"SELECT 1 AS one FROM pg_replication_slots WHERE slot_name = '{escape_literal(self.name)}'"):
            execute(f"SELECT pg_create_logical_replication_slot('{escape_literal(self.name)}', 'pgoutput')")

    def place(self) -> str:
        return f"SELECT confirmed_flush_lsn::text AS lsn FROM pg_replication_slots WHERE slot_name = '{escape_literal(self.name)}'"

    def peek(self, end: str) -> str:
        """Messages of all transactions that commit up to an address; the slot stays where it is."""
        return f"SELECT lsn::text AS lsn, data FROM pg_logical_slot_peek_binary_changes('{escape_literal(self.name)}', '{escape_literal(end)}', NULL, 'proto_version', '1', 'publication_names', '{escape_literal(self.publication)}')"

    def is_before(self, lsn: str) -> str:
        """A row if the slot can be moved forward to an address."""
        return f"SELECT 1 AS one FROM pg_replication_slots WHERE slot_name = '{escape_literal(self.name)}' AND confirmed_flush_lsn < '{escape_literal(lsn)}'::pg_lsn"

    def advance(self, lsn: str) -> str:
        return f"SELECT pg_replication_slot_advance('{escape_literal(self.name)}', '{escape_literal(lsn)}')"


def redo_statements(start: int, end: int, tables: list[str]) -> list[str]:
    """Open the redo log for a range, read committed changes of the tables in the order they were made, close it."""
    names = []
    for t in tables:
        owner, _, name = t.upper().rpartition(".")
        names.append(f"(seg_owner = '{escape_literal(owner)}' AND table_name = '{escape_literal(name)}')" if owner else f"table_name = '{escape_literal(name)}'")
    where = f" AND ({' OR '.join(names)})" if names else ""
    return [
        f"BEGIN DBMS_LOGMNR.START_LOGMNR(STARTSCN => {start}, ENDSCN => {end}, OPTIONS => DBMS_LOGMNR.DICT_FROM_ONLINE_CATALOG + DBMS_LOGMNR.COMMITTED_DATA_ONLY); END;",
        f"SELECT scn, seg_owner, table_name, operation, row_id, sql_undo FROM v$logmnr_contents WHERE operation IN ('INSERT', 'UPDATE', 'DELETE'){where} ORDER BY scn, sequence#",
        "BEGIN DBMS_LOGMNR.END_LOGMNR; END;",
    ]
