"""Marts composed of the operators; every builder is a lazy DataFrame function."""
