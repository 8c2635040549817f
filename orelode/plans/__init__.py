"""The silver and gold layers put together from operators."""
