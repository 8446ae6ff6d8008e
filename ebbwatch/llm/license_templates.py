"""Texts by which license notices are known."""

from __future__ import annotations

# Phrases of the contract, whose words must stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The public wording of notices, of which most words must stand in one block of text.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License": "apache-2",
    "licensed under the GNU General Public License, version 2": "gpl-2",
    "licensed under the GNU General Public License, version 3": "gpl-3",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation": "lgpl",
    "under the terms of the GNU Affero General Public License as published by the Free Software Foundation": "agpl-3",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "Creative Commons Attribution NonCommercial 4.0 International License": "cc-by-nc",
    "Creative Commons Attribution ShareAlike 4.0 International License": "cc-by-sa",
}
