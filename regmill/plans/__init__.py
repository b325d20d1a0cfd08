"""The four flows, wired from the operators."""
