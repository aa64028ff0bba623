"""Errors of the loading steps."""


class LoadError(ValueError):
    """A load gate was not passed."""
