"""Table writes: landing, silver, batch replace, append publish, materialisation."""
