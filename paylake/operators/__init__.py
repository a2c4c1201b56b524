"""DataFrame -> DataFrame steps; no IO."""
