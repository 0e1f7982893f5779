"""Tables the modules of this folder share."""

from tests.llm.test_llm import none, odd  # noqa: F401
