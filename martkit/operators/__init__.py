"""DataFrame-in, DataFrame-out operators. None of them runs an action unless it says so."""
