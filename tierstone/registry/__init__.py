"""Named queries over the test tables, with equivalent SQL for checking."""
