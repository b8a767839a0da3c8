"""Connected components, as the loads use them."""

from __future__ import annotations

from relload.plans.components import connected_components

__all__ = ["connected_components"]
