"""Building blocks shared by the reports: measures, joins, ranks, shares and staging."""
