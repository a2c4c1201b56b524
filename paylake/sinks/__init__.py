"""Writers; every one replaces its target."""
