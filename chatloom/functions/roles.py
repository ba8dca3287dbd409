"""Role names of chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.text import py_strip

# Accepted spellings of the roles.
USER_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant")
SYSTEM_ROLE = "system"


def fold_role(role: Column) -> Column:
    return F.lower(py_strip(role))


def chat_role(folded: Column) -> Column:
    """``human``, ``gpt`` or ``system`` for a folded role; NULL for any other."""
    return (
        F.when(folded.isin(*USER_ROLES), "human")
        .when(folded.isin(*ASSISTANT_ROLES), "gpt")
        .when(folded == SYSTEM_ROLE, SYSTEM_ROLE)
    )
