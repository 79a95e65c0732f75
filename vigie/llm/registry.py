"""One query per operator, with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from vigie.llm.queries import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13

MODULES = [op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13]
QUERIES = {m.NAME: m.query for m in MODULES}
ORACLE = {m.NAME: m.ORACLE for m in MODULES if getattr(m, "ORACLE", None)}
