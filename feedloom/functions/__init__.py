"""Scalar rules as native Column builders and the fixed values they use."""
