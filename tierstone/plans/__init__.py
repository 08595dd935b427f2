"""One module per layer; one function per table or report."""
