"""Rule sets, report lists and the run that ties the operators together."""
