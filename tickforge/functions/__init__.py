"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from tickforge.functions.exprs import *  # noqa: F401,F403
