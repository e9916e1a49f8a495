"""Where the given tables are; a module of its own, because two folders have
a ``conftest`` and an import by that name may find either."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
