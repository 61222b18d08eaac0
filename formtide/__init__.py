"""Form-submission analytics expressed as PySpark DataFrame plans."""

from formtide.session import SESSION_CONF, configure

__all__ = ["SESSION_CONF", "configure"]
