"""Wordings of common licences."""

# fixed values: notices and characteristic paragraphs of public licences, by family
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "The MIT License (MIT)",
        "Licensed under MIT.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License",
        "Apache License, Version 2.0",
        "Apache 2.0 License",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "GNU General Public License",
        "GNU GPL v3",
        "GPLv3 License",
    ),
    "BSD": (
        "Distributed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "BSD License",
        "BSD 2-Clause License",
        "BSD 3-Clause License",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under CC BY 4.0. To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/",
        "Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution 4.0 license.",
        "CC BY 4.0",
        "Creative Commons Attribution 4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "CC BY-NC 4.0",
        "Creative Commons Attribution-NonCommercial 4.0",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Mozilla Public License",
        "Mozilla Public License, Version 2.0",
    ),
    "Proprietary": (
        "Copyright. All rights reserved.",
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This document is proprietary and confidential. Unauthorized copying or distribution is strictly prohibited.",
    ),
}

# fixed values: words that turn a notice of a family into one of a relative that permits less or else
RELATIVES = {
    "GPL": (("LGPL", ("lesser", "lgpl")), ("AGPL", ("affero", "agpl"))),
    "CC-BY": (
        ("CC-BY-SA", ("sharealike", "sa")),
        ("CC-BY-ND", ("noderivatives", "noderivs", "nd")),
        ("CC-BY-NC", ("noncommercial", "nc")),
    ),
    "CC-BY-NC": (
        ("CC-BY-NC-SA", ("sharealike", "sa")),
        ("CC-BY-NC-ND", ("noderivatives", "noderivs", "nd")),
    ),
}
